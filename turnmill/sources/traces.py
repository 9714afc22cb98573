"""Session-log sources and sinks.

Raw logs are directories of ``*.jsonl`` files, one session per file, one
event per line. The scan is Spark's text source (split into file blocks
as usual); each line keeps its file path and a file-order key
``ord = (block start, row id)`` taken right above the scan, so order is
known without reading a file in one task.

Events are parsed with ``from_json`` into a fixed schema, strings of any
length. The message content is a string, a list of blocks, or something
else; it is kept as raw JSON text, which keeps the order of keys (the last
of repeated keys counts, as in Python) and has no size limit. A second
typed parse tells a list from a string that looks like one. Lines that
are blank, not JSON, or not a JSON object are dropped and counted
(``bad`` flag), without dropping the rest of the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..session import store

# Strings are limited by the size of a cell only.
JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "maxStringLen": "2147483647"}
EVENT_SCHEMA = (
    "type STRING, uuid STRING, requestId STRING, cwd STRING, gitBranch STRING, version STRING, "
    "message STRUCT<id: STRING, role: STRING, model: STRING, content: STRING, usage: STRING>, "
    "_corrupt_record STRING"
)
LIST_SCHEMA = "message STRUCT<content: ARRAY<STRING>>"


# Blocks of a mixed list that one step puts together.
BLOCK_STEP = 256


def block_list(content: Column, raws: Column) -> Column:
    """Blocks of a content list as ``(raw, quoted)``: JSON text of a block,
    or the plain string that stands in its place.

    ``content`` is the compact text of the whole list, ``raws`` its elements
    with strings unquoted. If joining the elements gives the list back, none
    was quoted; else each element's first byte says so, at the position that
    the sizes of the elements before it add up to. A byte is found in
    constant time, and elements are put together in steps, so the work
    follows the size of the list."""
    text = F.transform(raws, lambda x: F.coalesce(x, F.lit("null")))
    none_quoted = content == F.concat(F.lit("["), F.array_join(text, ","), F.lit("]"))
    empty = F.array().cast("array<struct<raw:string,quoted:boolean>>")

    def marked(whole):  # bound once: an expression in the steps would run again in each of them
        octets, items = whole["octets"], whole["items"]

        def one(state, x):
            quoted = F.substring(octets, state["at"], F.lit(1)) == F.lit(b'"')
            size = F.when(quoted, F.octet_length(F.to_json(F.array(x))) - 2).otherwise(F.octet_length(x))
            return F.struct((state["at"] + size + 1).alias("at"),
                            F.concat(state["out"], F.array(F.struct(x.alias("raw"), quoted.alias("quoted")))).alias("out"))

        def step(state, i):
            some = F.aggregate(F.slice(items, i * BLOCK_STEP + 1, F.lit(BLOCK_STEP)), F.struct(state["at"].alias("at"), empty.alias("out")), one)
            return F.transform(F.array(some), lambda s: F.struct(s["at"].alias("at"), F.concat(state["out"], s["out"]).alias("out")))[0]

        steps = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK_STEP).cast("int"))
        return F.aggregate(steps, F.struct(F.lit(2).alias("at"), empty.alias("out")), step, lambda state: state["out"])

    mixed = F.transform(F.array(F.struct(F.encode(content, "UTF-8").alias("octets"), text.alias("items"))), marked)[0]
    return F.when(raws.isNull(), F.lit(None)).when(
        none_quoted, F.transform(text, lambda x: F.struct(x.alias("raw"), F.lit(False).alias("quoted")))).otherwise(mixed)


def read_trace_lines(spark: SparkSession, root: str, include_subagents: bool = False,
                     pattern: str = "*.jsonl") -> DataFrame:
    """All ``pattern`` files under ``root`` (recursively) as
    ``(path, ord, n_bytes, value)``; lines end at the line feed, which counts
    as a byte of its line. Sub-agent sessions (path containing
    ``subagents``) are left out unless asked for; the path test runs on
    the scan's metadata column, before any parsing."""
    df = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("lineSep", "\n").text(root)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.struct(F.col("_metadata.file_block_start").alias("blk"),
                     F.monotonically_increasing_id().alias("row")).alias("ord"),
            (F.octet_length("value") + 1).cast("bigint").alias("n_bytes"),
            "value",
        )
    )
    if not include_subagents:
        df = df.where(~F.col("path").contains("subagents"))
    return df


def parse_events(lines: DataFrame) -> DataFrame:
    """``(path, ord, value)`` -> one row per line with the event fields.

    ``bad`` marks lines that are blank or not a JSON object (kept so the
    ledger can count them; every later step filters them out). ``kind`` of
    the content: ``list`` (then ``blocks``), ``text`` (a string, or other
    JSON as text, in ``content``), ``null`` or missing (NULL). A message
    that is an empty object is no message.

    Only content whose text begins like a list is parsed as one: a parse that
    fails costs many times one that succeeds."""
    p = lines.select("path", "ord", "value", is_blank("value").alias("_blank"), F.from_json("value", EVENT_SCHEMA, JSON).alias("e"))
    raws = F.from_json("value", LIST_SCHEMA, JSON).getField("message").getField("content")
    p = p.withColumn("_raws", F.when(F.col("e.message.content").startswith("["), raws))
    bad = F.col("_blank") | F.col("e").isNull() | F.col("e._corrupt_record").isNotNull()
    content, raw_message = F.col("e.message.content"), F.get_json_object("value", "$.message")
    empty = F.coalesce(*[F.col(f"e.message.{c}") for c in ("id", "role", "model", "content", "usage")]).isNull()
    has = F.when(F.col("e.message").isNull(), False).when(empty, F.coalesce(raw_message != "{}", F.lit(False))).otherwise(True)
    null_content = content.isNull() & F.array_contains(F.json_object_keys(raw_message), "content")
    kind = F.when(F.col("_raws").isNotNull(), "list").when(content.isNotNull(), "text").when(null_content, "null")
    return p.select(
        "path", "ord", bad.alias("bad"),
        F.col("e.type").alias("type"),
        F.col("e.uuid").alias("uuid"),
        F.col("e.requestId").alias("request_id"),
        F.col("e.cwd").alias("cwd"),
        F.col("e.gitBranch").alias("git_branch"),
        F.col("e.version").alias("version"),
        has.alias("has_message"),
        F.col("e.message.id").alias("msg_id"),
        F.col("e.message.role").alias("msg_role"),
        F.col("e.message.model").alias("model"),
        kind.alias("kind"),
        content.alias("content"),
        block_list(content, F.col("_raws")).alias("blocks"),
        F.col("e.message.usage").alias("usage"),
    )


def read_events(spark: SparkSession, root: str, include_subagents: bool = False) -> DataFrame:
    return parse_events(read_trace_lines(spark, root, include_subagents))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-lines sink; UTF-8 text is written as is (not escaped)."""
    df.write.mode(mode).json(path)


def line_addresses(lines: DataFrame, key: str = "path") -> DataFrame:
    """``key, ord, address``: the byte where each line begins in its file.

    ``lines`` are *stored* rows of a scan with ``ord`` (block, row) and
    ``n_bytes``. The address is the sum of the sizes before a line: within its
    block, plus the blocks before, from one row per block; so it is the same
    however the scan was split."""
    d = lines.select(key, "ord", F.col("ord.blk").alias("blk"), "n_bytes")
    w = Window.partitionBy(key, "blk").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = d.withColumn("_at", F.sum("n_bytes").over(w) - F.col("n_bytes"))
    before = Window.partitionBy(key).orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = d.groupBy(key, "blk").agg(F.sum("n_bytes").alias("_n"))
    blocks = blocks.select(key, "blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return local.join(blocks, [key, "blk"], "inner").select(key, "ord", (F.col("_off") + F.col("_at")).cast("bigint").alias("address"))


# Bytes that one file of a per-label set holds about.
FILE_BYTES = 128 << 20


def write_partitioned(df: DataFrame, path: str, by: str = "label", mode: str = "overwrite", file_bytes: int = FILE_BYTES) -> None:
    """One directory per value of ``by`` (per-label sets). A label's rows are
    dealt at random to as many tasks as its size asks for, so a hot label is
    written by many tasks, in files of about ``file_bytes``, and a small one
    by a single task, however many tasks there are."""
    row = F.to_json(F.struct(*[c for c in df.columns if c != by]))
    sizes = df.groupBy(by).agg(F.ceil(F.sum(F.octet_length(row)) / file_bytes).cast("int").alias("_files"))
    part = F.pmod(F.xxhash64(row), F.greatest("_files", F.lit(1))).cast("int")
    dealt = df.join(sizes, df[by].eqNullSafe(sizes[by]), "left").select(df["*"], part.alias("_part"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt.repartition(n, by, "_part").drop("_part").write.mode(mode).partitionBy(by).json(path)


def dataset_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON-lines dataset, stored: ``path, ord, n_bytes, cause`` and the row
    ``r``; ``cause`` says what is wrong with a line (``blank`` or
    ``not an object of the schema``), whose row is then NULL."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start").alias("blk"), F.monotonically_increasing_id().alias("row")).alias("ord"),
        (F.octet_length("value") + 1).cast("bigint").alias("n_bytes"), "value")
    parsed = F.from_json("value", schema + ", _corrupt_record STRING", JSON)
    lines = lines.select("path", "ord", "n_bytes", is_blank("value").alias("_blank"), parsed.alias("p"))
    cause = F.when(F.col("_blank"), "blank").when(F.col("p").isNull() | F.col("p._corrupt_record").isNotNull(), "not an object of the schema")
    return store(lines.select("path", "ord", "n_bytes", cause.alias("cause"), F.when(cause.isNull(), F.col("p").dropFields("_corrupt_record")).alias("r")), "dataset")


def faults(rows: DataFrame) -> DataFrame:
    """``path, address, cause`` of the bad lines of ``dataset_rows``."""
    bad = rows.where("cause is not null").select("path", "ord", "cause")
    return line_addresses(rows).join(bad, ["path", "ord"], "inner").select("path", "address", "cause")


FAULTS_NAMED = 5


def read_dataset(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON-lines dataset with a given schema as ``path, address`` (the byte
    where the line begins) and its columns. When ``strict``, bad lines fail
    the read, which names the first few (the original aborts at the first);
    else they are left out."""
    rows = dataset_rows(spark, path, schema)
    if strict:
        bad = faults(rows).orderBy("path", "address").limit(FAULTS_NAMED).collect()
        if bad:
            raise ValueError("bad lines: " + "; ".join(f"{r.path} at byte {r.address}: {r.cause}" for r in bad))
    return rows.where("cause is null").join(line_addresses(rows), ["path", "ord"], "inner").select("path", "address", "r.*")
