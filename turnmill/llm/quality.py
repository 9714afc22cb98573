"""Quality classifier: hierarchical empirical Bayes over documents, paths
and hosts.

1. Document evidence. Naive Bayes log-likelihood ratios, once for low
   quality and once for toxicity, over the distinct words of a document
   (only words that speak against it count: the many ordinary ones would
   outvote them) and a few shape bins (share of marks, capitals and
   distinct words, word length; of the text and of its worst line).
   Near copies in the sample would make their words look telling, so only
   one document per least shingle hash is learned from (texts without words
   have none and all count). Learned from a bounded sample of labelled documents
   (``TRAIN_DOCS`` distinct texts at most, by hash); only features seen in
   at least ``SUPPORT`` of them and with a ratio of ``LEAST_RATIO`` or more
   count, ``FEATURES`` at most.
2. Site evidence. Every document's posterior under the global prior is
   summed per path and per host by one grouped aggregation over all
   documents. A host's rate is shrunk toward the global rate and a
   path's toward its host's, with strengths estimated from the spread of
   the rates between sites (method of moments): sparse sites lean on
   their parent, dense ones on themselves.
3. The decision. A document's final log odds are its own evidence plus
   the log odds of its path. It is rejected if its probability of low
   quality or of toxicity is ``REJECT`` or more.

Here the host is the document's source and the path its language within
the source. The evidence is computed twice (for the sites and for the
decision) rather than shuffling texts. Site tables are written, so they
are broadcast only if their file is under the session's threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import bounded_batches, stored, unwrapped, wrapped, written
from turnmill.llm.mixing import category
from turnmill.llm.probminhash import mixed as scrambled
from turnmill.llm.probminhash import shingles

TRAIN_DOCS = 20_000
FEATURES = 100_000
SUPPORT = 5
LEAST_RATIO = 1.0
# Least chi-square (one degree of freedom) of a feature against the label: no
# feature among 100,000 should pass by chance.
LEAST_CHI2 = 30.0
SMOOTH = 0.5
# Losing a clean document costs more than keeping a poor one.
REJECT = 0.9
# Shape is taken per stretch of so many words; the worst stretch counts.
STRETCH = 64
# Bounds of the estimated shrinkage strength, in documents.
STRENGTH = (10.0, 1e6)

MARKS = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
CAPITALS = bytes(range(65, 91))
NOT_LETTERS = bytes(range(65)) + bytes(range(91, 97)) + bytes(range(123, 128))
TO_SPACE = bytes(32 if i in set(NOT_LETTERS) else i for i in range(256))


def level(x: float) -> int:
    """Bin of a share: one per factor of two, 0 for none."""
    return 0 if x <= 0 else max(1, 12 + math.floor(math.log2(x)))


def features(text: str | None) -> set[bytes]:
    """Distinct lower-case words (runs of letters) and shape bins. Without
    any text there is one feature, the bin for it."""
    if not text or text.isspace():
        return {b"#empty"}
    tokens = text.lower().encode("utf-8", "replace").split()
    found = set(b" ".join(tokens).translate(TO_SPACE).split())
    cased = text.encode("utf-8", "replace").split()
    stretches = [cased[i : i + STRETCH] for i in range(0, len(cased), STRETCH)]
    if len(stretches) > 1 and len(stretches[-1]) < STRETCH // 4:
        stretches.pop()
    worst = [max(column) for column in zip(*(shape(x) for x in stretches), strict=True)]
    return found | {f"#{k}{v}".encode() for k, v in zip(("marks", "capitals", "repeated", "length"), worst, strict=True)}


def shape(tokens: list[bytes]) -> tuple[int, int, int, int]:
    """Bins of a stretch: share of marks, share of capitals, tenths of
    words that repeat an earlier one, mean length of a word."""
    raw = b" ".join(tokens)
    words = raw.lower().translate(TO_SPACE).split()
    n = len(raw)
    return (level(1 - len(raw.translate(None, MARKS)) / n), level(1 - len(raw.translate(None, CAPITALS)) / n),
            10 - 10 * len(set(words)) // max(1, len(words)), min(12, n // max(1, len(words))))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(text, low, toxic) of at most ``size`` labelled documents, by hash of
    the id. Several labels of a document count as the worst of them."""
    known = (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .groupBy("doc_id").agg((F.min("quality") < 1).cast("int").alias("low"), (F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    draw = F.xxhash64(F.lit("train"), "doc_id")
    total = labels.count()
    share = min(1.0, 1.2 * size / max(1, total))
    few = (
        known.withColumn("draw", draw).where(F.shiftrightunsigned("draw", 11) * F.lit(2.0**-53) < share)
        .orderBy("draw", "doc_id").limit(size).select(F.col("doc_id").alias("_id"), "low", "toxic")
    )
    # At most ``size`` narrow rows.
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(few), F.col("id") == F.col("_id"))
    d = d.select("id", "text", "low", "toxic", least_shingles("text").alias("least"))
    for i in range(2):
        first = F.min(F.struct("id", "low", "toxic", "text", "least")).alias("d")
        # Texts without words have no shingles: each stands for itself.
        alone = F.when(F.col("least").isNull(), F.col("id")).alias("alone")
        d = d.groupBy(F.col("least")[i].alias("k"), alone).agg(first).select("d.*")
    return d.select("text", "low", "toxic")


def least_shingles(text: str) -> Column:
    """Two least hashes of a text's five-word shingles, under two orders;
    null without words."""

    @F.pandas_udf("array<bigint>")
    def find(texts: pd.Series) -> pd.Series:
        def least(t):
            h = shingles(t or "")[0]
            return [int(x.min()) for x in (h.view("int64"), scrambled(h).view("int64"))] if len(h) else None

        return texts.map(least)

    return find(F.col(text))


def feature_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = [(w, a, b) for t, a, b in zip(f["text"], f["low"], f["toxic"], strict=True) for w in features(t)]
        yield pd.DataFrame(rows, columns=["feature", "low", "toxic"])


def train(sample: DataFrame) -> tuple[dict[bytes, tuple[float, float]], tuple[float, float]]:
    """(log ratios (low, toxic) by feature, global rates). Without labels:
    no features and rates of one in a million."""
    sample = stored(sample)
    n, low, toxic = sample.agg(F.count(F.lit(1)), F.sum("low"), F.sum("toxic")).first()
    if not n:
        return {}, (1e-6, 1e-6)

    def ratio(hits: str, yes: int) -> Column:
        seen, got, no = F.col("n"), F.col(hits), n - yes
        r = F.log(((got + SMOOTH) / (yes + 2 * SMOOTH)) / ((seen - got + SMOOTH) / (no + 2 * SMOOTH)))
        off = got * no - (seen - got) * yes
        # A feature in every document says nothing (and has no variance).
        chi2 = F.lit(float(n)) * off * off / F.nullif(F.lit(float(yes)) * no * seen * (n - seen), F.lit(0.0))
        speaks = (r >= LEAST_RATIO) | (r <= -LEAST_RATIO) & F.col("feature").startswith(F.lit(b"#"))
        return F.when(speaks & (chi2 >= LEAST_CHI2), r).otherwise(0.0)

    counts = (
        sample.mapInPandas(feature_rows, "feature binary, low int, toxic int")
        .groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("low").alias("low"), F.sum("toxic").alias("toxic"))
        .where(F.col("n") >= SUPPORT)
        .select("feature", ratio("low", low).alias("rl"), ratio("toxic", toxic).alias("rt"))
        .where("rl != 0 or rt != 0")
        .orderBy(F.desc(F.greatest(F.abs("rl"), F.abs("rt"))), "feature").limit(FEATURES)
    )
    weights = {bytes(r["feature"]): (r["rl"], r["rt"]) for r in counts.collect()}
    return weights, ((low + SMOOTH) / (n + 1), (toxic + SMOOTH) / (n + 1))


def evidence(model):
    """Column function: (low, toxic) log-likelihood ratios of a text."""

    @F.pandas_udf("struct<low:double,toxic:double>")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights = model.value
        names = weights.keys()
        for s in texts:
            rows = []
            for t in s:
                hits = [weights[w] for w in sorted(names & features(t))]
                rows.append((math.fsum(h[0] for h in hits), math.fsum(h[1] for h in hits)))
            yield pd.DataFrame(rows, columns=["low", "toxic"])

    return score


def odds(p) -> Column:
    return F.log(p / (1 - p))


def chance(log_odds) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def strength(sites: DataFrame, parent: str) -> float:
    """Prior weight, in documents, of the parent's rate: the between-site
    variance left after sampling noise says how much sites differ."""
    r = sites.where("n >= 2").agg(
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col(parent), 2)).alias("spread"),
        F.sum(F.col(parent) * (1 - F.col(parent))).alias("noise"), F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col(parent) * (1 - F.col(parent))).alias("unit"),
    ).first()
    if not r["n"] or not r["unit"]:
        return STRENGTH[1]
    between = (r["spread"] - r["noise"]) / r["n"]
    unit = r["unit"] / r["n"]
    return STRENGTH[1] if between <= 0 else min(STRENGTH[1], max(STRENGTH[0], unit / between - 1))


def site_rates(paths: DataFrame, rate: float, posterior: str) -> DataFrame:
    """(_h, _p, rate) of every path, shrunk to its host and the whole."""
    all_n, all_s = paths.agg(F.sum("n"), F.sum(posterior)).first()
    mean = (all_s + rate) / (all_n + 1) if all_n else rate
    hosts = paths.groupBy("_h").agg(F.sum("n").alias("n"), F.sum(posterior).alias("s")).withColumn("up", F.lit(mean))
    k = strength(hosts, "up")
    hosts = hosts.select(F.col("_h").alias("host"), ((F.col("s") + k * F.col("up")) / (F.col("n") + k)).alias("up"))
    under = paths.select("_h", "_p", "n", F.col(posterior).alias("s")).join(hosts, F.col("_h") == F.col("host"))
    k = strength(under, "up")
    return under.select("_h", "_p", ((F.col("s") + k * F.col("up")) / (F.col("n") + k)).alias(f"{posterior}_rate"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           host_col: str = "source", path_col: str = "lang", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(row, low, toxic, keep): every input row whole, the final
    probabilities and the decision.

    Null and empty texts have a feature of their own and are judged by what
    the labels say of such texts and by their site. Null hosts and paths
    are sites of their own. Rows are judged one by one, so repeated rows get
    the same decision. Without usable labels everything is kept; an empty
    table stays empty."""
    bounded_batches(docs.sparkSession)
    weights, rates = train(labelled_sample(docs, labels, id_col, text_col, train_docs))
    model = docs.sparkSession.sparkContext.broadcast(weights)
    scored = wrapped(docs, _h=category(host_col), _p=category(path_col), e=evidence(model)(F.col(text_col)))
    prior = [math.log(r / (1 - r)) for r in rates]
    paths = written(
        scored.groupBy("_h", "_p").agg(
            F.count(F.lit(1)).alias("n"), F.sum(chance(F.col("e.low") + prior[0])).alias("low"),
            F.sum(chance(F.col("e.toxic") + prior[1])).alias("toxic")), "quality-paths")
    sites = site_rates(paths, rates[0], "low").join(site_rates(paths, rates[1], "toxic"), ["_h", "_p"])
    sites = written(sites, "quality-sites").withColumnsRenamed({"_h": "sh", "_p": "sp"})
    d = scored.join(sites, (F.col("_h") == F.col("sh")) & (F.col("_p") == F.col("sp")))
    d = d.select("row", chance(F.col("e.low") + odds(F.col("low_rate"))).alias("low"),
                 chance(F.col("e.toxic") + odds(F.col("toxic_rate"))).alias("toxic"))
    return d.withColumn("keep", (F.col("low") < REJECT) & (F.col("toxic") < REJECT))


def quality_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, low_quality, toxic, keep) per document."""
    d = judged(docs.select("doc_id", "text", "source", "lang"), labels)
    return d.select("row.doc_id", F.round("low", 6).alias("low_quality"), F.round("toxic", 6).alias("toxic"), "keep")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept rows, with the columns of ``docs``."""
    return unwrapped(judged(docs, labels).where("keep"))
