"""Near-duplicate documents by ProbMinHash signatures, banding and exact
verification.

A document is its set of five-word shingles (lower-case words between
white space). Signatures can weigh shingles (weight 1 + ln(count)); those
that are banded give all the same weight, since pairs are judged by plain
Jaccard similarity, which is then what banding finds. Each shingle runs a
Poisson process whose rate is its weight; every arrival hits one of
``SLOTS`` signature slots, and a slot keeps the shingle of its earliest
arrival. Two signatures agree in a slot with the probability Jaccard
similarity of the weighted sets. Processes stop as soon as their next
arrival is later than the latest slot of their document, so a long
document costs little more than one arrival per shingle.

Slots are banded, ``ROWS`` to a band: a pair at similarity 0.8 shares a
band with probability 1 - (1 - 0.8^4)^24 > 0.99999. Within a bucket the
text that shares the most buckets with others leads, and the others are
compared with it: a star, not all pairs, since a class of near copies has
one text near to all. Pairs are verified on the whole texts by the exact
Jaccard similarity of their shingle sets (0.8 or more). Texts that are
then not in the class of their bucket's leader meet the bucket's next
leader (``PASSES`` stars). What stars leave open is settled by an exact
join: among the texts of all buckets that still hold several classes, the
pairs across classes at 0.8 or more are found by prefixes of their shingle
sets (``crossing``). Where more than ``HOT`` texts outside the largest
class stand under one entry of that join, as in families of texts put
together from common parts, the entry doesn't list its pairs. All its texts
are banded again, sharply (``SHARP_ROWS`` of ``SHARP_SLOTS`` slots to a
bucket, ``SHARP_BANDS`` buckets): a pair at similarity 0.8 misses every
bucket with probability 2e-6, less than in the first bands, while pairs at
0.43 meet in one of eighty cases instead of always. Their pairs must then
agree in ``SHARP_LEAST`` slots before any text moves. Families whose texts
lie just under 0.8 to each other still cost pairs in proportion to their
square. Classes are connected components.

Equal texts are one text from the start (128-bit hash), so a group of
exact copies of any size is one row in every later step.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import discard, text_key, unwrapped, wrapped, written

SHINGLE = 5
SIMILAR = 0.8
ROWS = 4
BANDS = 24
SLOTS = ROWS * BANDS
PASSES = 2
# Ratio between the size classes of the exact join; slack for its doubles.
GROWTH, SLACK = 1.03, 1e-3
# Texts outside its largest class that an entry of the exact join pairs up.
HOT = 1000
# Sharp bands: slots drawn for each band (a fixed draw), and the agreeing
# slots below which no pair at 0.8 is left (5.5 standard deviations).
SHARP_SLOTS, SHARP_ROWS, SHARP_BANDS, SHARP_LEAST = 512, 12, 300, 360
DRAWN = np.array([np.random.default_rng((SHARP_SLOTS, i)).permutation(SHARP_SLOTS)[:SHARP_ROWS] for i in range(SHARP_BANDS)])
# Shingles and signatures that are worked on at once in a Python worker.
CHUNK, SHARP_SETS = 200_000, 500

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
LINK = np.uint64(0x100000001B3)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, how often each occurs). A text of one to
    four words is a single shingle; one without words has none."""
    words = text.lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    w = mixed(np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + GOLDEN)
    n = min(SHINGLE, len(w))
    h = np.zeros(len(w) - n + 1, np.uint64)
    for i in range(n):
        h = mixed(h * LINK + w[i : len(w) - n + 1 + i])
    return np.unique(h, return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` shingle hashes per weighted set (all zero for
    an empty set), all sets worked on together."""
    sizes = np.array([len(h) for h, _ in sets])
    first = np.full((len(sets), slots), np.inf)
    owner = np.zeros((len(sets), slots), np.uint64)
    if not sizes.sum():
        return owner
    items = np.concatenate([h for h, _ in sets])
    rate = 1.0 + np.log(np.concatenate([c for _, c in sets]))
    doc = np.repeat(np.arange(len(sets)), sizes)
    state, at = mixed(items + GOLDEN), np.zeros(len(items))
    flat_first, flat_owner = first.ravel(), owner.ravel()
    while len(items):
        state = mixed(state + GOLDEN)
        u = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        at = at - np.log(u) / rate
        slot = doc * slots + (mixed(state ^ LINK) >> np.uint64(33)).astype(np.int64) % slots
        np.minimum.at(flat_first, slot, at)
        won = flat_first[slot] == at
        flat_owner[slot[won]] = items[won]
        # A process whose last arrival is past every slot of its document
        # can't win any more.
        latest = first.max(axis=1)
        live = at < latest[doc]
        items, rate, doc, state, at = items[live], rate[live], doc[live], state[live], at[live]
    return owner


def bands(owner: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band of each signature."""
    o = owner.reshape(len(owner), -1, ROWS)
    h = np.broadcast_to(np.arange(o.shape[1], dtype=np.uint64), o.shape[:2]).copy()
    for i in range(ROWS):
        h = mixed(h * LINK + o[:, :, i] + GOLDEN)
    return h.view(np.int64)


def sketched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, text) -> (id, key, buckets); no buckets without words."""
    for f in frames:
        at, room, ids, sets, keys = 0, CHUNK, [], [], []

        def flush(ids, keys, sets):
            # The verdict is on plain sets: equal rates, else texts that repeat
            # shared passages in different numbers would seem less near.
            b = bands(signatures([(h, np.ones_like(n)) for h, n in sets]))
            return pd.DataFrame({"id": ids, "key": keys, "buckets": [x if len(s[0]) else [] for x, s in zip(b, sets, strict=True)]})

        for i, t in zip(f["id"], f["text"], strict=True):
            ids.append(None if pd.isna(i) else int(i))
            keys.append(hashlib.md5(t.encode("utf-8", "surrogatepass")).digest())
            sets.append(shingles(t))
            room -= len(sets[-1][0])
            at += 1
            if room <= 0:
                yield flush(pd.array(ids, "Int64"), keys, sets)
                room, ids, sets, keys = CHUNK, [], [], []
        if ids:
            yield flush(pd.array(ids, "Int64"), keys, sets)


def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b, ta, tb) -> (a, b) of the pairs that are similar; rows come
    with equal ``b`` together, whose shingles are then made once."""
    last, of_last = None, None
    for f in frames:
        a, b = [], []
        for ka, kb, ta, tb in zip(f["a"], f["b"], f["ta"], f["tb"], strict=True):
            if kb != last:
                last, of_last = kb, shingles(tb)[0]
            sa = shingles(ta)[0]
            small, large = sorted((len(sa), len(of_last)))
            if not small or small < SIMILAR * large:
                continue
            both = len(np.intersect1d(sa, of_last, assume_unique=True))
            if both >= SIMILAR * (small + large - both):
                a.append(ka)
                b.append(kb)
        yield pd.DataFrame({"a": a, "b": b})


def texts_of(docs: DataFrame) -> DataFrame:
    """(key, id, n, buckets): one written row per distinct non-null text; id
    is the smallest of its documents' (null if none has one)."""
    d = docs.where("text is not null")
    sketch = d.mapInPandas(sketched, "id bigint, key binary, buckets array<bigint>")
    found = sketch.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("buckets").alias("buckets"))
    return written(found, "near-texts")


def whole_texts(keys: DataFrame, docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, text), written, of the text keys in ``keys`` (key). Texts are
    looked up by one of their documents (id and key)."""
    wanted = keys.join(texts.select("key", "id"), "key").select(F.col("key").alias("k"), F.col("id").alias("i"))
    keyed = docs.where("text is not null").withColumn("key", text_key("text"))
    return written(
        keyed.join(wanted, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")
        .select("key", "text").dropDuplicates(["key"]), "near-whole")


def verified(pairs: DataFrame, docs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of text keys whose texts are similar. Only the texts
    of a pair move."""
    whole = whole_texts(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), docs, texts)
    d = pairs.join(whole.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a")
    d = d.join(whole.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b")
    found = written(d.select("a", "b", "ta", "tb").mapInPandas(compared, "a binary, b binary"), "near-links")
    discard(whole)
    return found


def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, class, text) -> (key, class, n, shingles)."""
    for f in frames:
        at, room, found = 0, CHUNK, []
        for end, t in enumerate(f["text"], 1):
            found.append(shingles(t)[0].view(np.int64))
            room -= len(found[-1])
            if room <= 0 or end == len(f):
                yield f.iloc[at:end][["key", "class"]].assign(n=[len(x) for x in found], shingles=found)
                at, room, found = end, CHUNK, []


def sharpened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, class, n, hot, text) -> (key, class, n, sketch, buckets): one
    byte of every slot of a longer signature, and the sharp bands of hot
    texts."""
    for f in frames:
        at, room, sets = 0, CHUNK, []
        for end, t in enumerate(f["text"], 1):
            h = shingles(t)[0]
            sets.append((h, np.ones(len(h), np.int64)))
            room -= len(h)
            if room <= 0 or len(sets) == SHARP_SETS or end == len(f):
                part = f.iloc[at:end]
                owner = signatures(sets, SHARP_SLOTS)
                sketch = (mixed(owner) >> np.uint64(56)).astype(np.uint8)
                buckets = [[] for _ in sets]
                hot = np.flatnonzero(part["hot"])
                h = np.broadcast_to(np.arange(SHARP_BANDS, dtype=np.uint64), (len(hot), SHARP_BANDS)).copy()
                for i in range(SHARP_ROWS):
                    h = mixed(h * LINK + owner[hot][:, DRAWN[:, i]] + GOLDEN)
                for i, b in zip(hot, h.view(np.int64), strict=True):
                    buckets[i] = b
                yield part[["key", "class", "n"]].assign(sketch=[x.tobytes() for x in sketch], buckets=buckets)
                at, room, sets = end, CHUNK, []


def agreeing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b, sa, sb) -> (a, b) of the pairs whose sketches agree enough."""
    for f in frames:
        if len(f):
            x, y = (np.frombuffer(b"".join(f[c]), np.uint8).reshape(len(f), SHARP_SLOTS) for c in ("sa", "sb"))
            yield f.loc[(x == y).sum(axis=1) >= SHARP_LEAST, ["a", "b"]]


def likely(listed_pairs: DataFrame, sets: DataFrame, hot: DataFrame, whole: DataFrame) -> DataFrame:
    """Candidates (a, b), written: of the pairs (a, b) already listed, and of
    those of different classes that meet in a sharp band of the texts ``hot``
    (key), the ones whose sketches agree enough. ``sets`` has (key, class, n)
    of all texts. The largest class of a bucket is never joined with itself."""
    wanted = listed_pairs.select(F.explode(F.array("a", "b")).alias("key"), F.lit(False).alias("hot"))
    wanted = wanted.unionByName(hot.select("key", F.lit(True).alias("hot"))).groupBy("key").agg(F.max("hot").alias("hot"))
    made = wanted.join(sets, "key").join(whole, "key").select("key", "class", "n", "hot", "text").mapInPandas(
        sharpened, "key binary, class binary, n int, sketch binary, buckets array<bigint>")
    made = written(made, "near-sharp")
    flat = made.select("key", "class", "n", F.explode("buckets").alias("bucket"))
    lone = flat.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("k")).groupBy("bucket").agg(
        F.max(F.struct("k", "class")).alias("top"), F.count(F.lit(1)).alias("classes")).where("classes > 1").select("bucket", "top")
    shared = written(flat.join(lone, "bucket"), "near-sharp-shared")
    a = shared.where("class != top.class").select("bucket", *[F.col(x).alias(f"{x}_a") for x in ("key", "class", "n")])
    near = F.least("n", "n_a") >= SIMILAR * F.greatest("n", "n_a") - SLACK
    sharp = a.join(shared, "bucket").where((F.col("class") != F.col("class_a")) & near).select(
        F.least("key", "key_a").alias("a"), F.greatest("key", "key_a").alias("b"))
    pairs = written(sharp.unionByName(listed_pairs).distinct(), "near-pairs")
    met = pairs.join(made.select(F.col("key").alias("a"), F.col("sketch").alias("sa")), "a")
    met = met.join(made.select(F.col("key").alias("b"), F.col("sketch").alias("sb")), "b")
    found = written(met.select("a", "b", "sa", "sb").mapInPandas(agreeing, "a binary, b binary"), "near-pairs")
    discard(made, shared, pairs)
    return found


def crossing(members: DataFrame, of: DataFrame, docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Candidates (a, b), written: pairs of texts of different classes, both
    in buckets (bucket, key) that hold several classes, among them every such
    pair that is similar.

    Shingles of one class alone come first in the order of all shingles, then
    those of several classes by how many texts hold them. If the first
    shingle that two sets of n and m share has r and q shingles from it on,
    they share min(r, q) at most, which has to reach s / (1 + s) * (n + m). So
    a set is entered, for every class of sizes that its partners can be of,
    with its first shingles only, and a passage that a family of texts has in
    common is at the end of all of them. The largest class under an entry is
    never joined with itself; what is left of an entry is paired up unless
    there are more than ``HOT`` texts of it, whose members are banded again
    (``likely``)."""
    now = written(members.join(of, "key", "left").select("bucket", "key", F.coalesce("class", "key").alias("class")), "near-members")
    several = now.groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi").select("bucket")
    open_ = written(now.join(several, "bucket", "left_semi").select("key", "class").distinct(), "near-open")
    whole = whole_texts(open_.select("key"), docs, texts)
    sets = whole.join(open_, "key").select("key", "class", "text").mapInPandas(listed, "key binary, class binary, n int, shingles array<bigint>")
    flat = sets.select("key", "class", "n", F.explode("shingles").alias("shingle"))
    shared = flat.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"), F.min("class").alias("lo"), F.max("class").alias("hi"))
    shared = written(shared.where("lo != hi").select("shingle", "often"), "near-shingles")
    ordered = flat.join(shared, "shingle").groupBy("key", "class", "n").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("list"))
    least = F.ceil(SIMILAR * F.col("n") - SLACK).cast("int")
    first = ordered.where(F.size("list") >= least).select(
        "key", "class", "n", F.size("list").alias("held"), F.posexplode(F.slice("list", F.lit(1), F.size("list") - least + 1)).alias("at", "s"))

    def sized(n) -> Column:
        return F.floor(F.log(n) / math.log(GROWTH)).cast("int")

    few, many = F.greatest(F.lit(1.0), SIMILAR * F.col("n") - SLACK), F.col("n") / SIMILAR + SLACK
    share = SIMILAR / (1 + SIMILAR)
    entries = (
        first.select("key", "class", "n", F.col("s.shingle").alias("shingle"), (F.col("held") - F.col("at")).alias("left"),
                     sized(F.col("n")).alias("own"), F.explode(F.sequence(sized(few), sized(many))).alias("other"))
        .where(F.col("left") >= share * (F.col("n") + F.greatest(few, F.pow(F.lit(GROWTH), F.col("other")))) - SLACK)
        .select("shingle", F.least("own", "other").alias("small"), F.greatest("own", "other").alias("large"), "own", "key", "class", "n", "left")
    )
    entries = written(entries, "near-entries")
    entry = ["shingle", "small", "large"]
    top = entries.groupBy(*entry, "class").agg(F.count(F.lit(1)).alias("k")).groupBy(*entry).agg(
        F.max(F.struct("k", "class")).alias("top"), F.count(F.lit(1)).alias("classes"), F.sum("k").alias("size")).where("classes > 1")
    top = written(top.select(*entry, "top", (F.col("size") - F.col("top.k") > HOT).alias("hot")), "near-tops")
    a = entries.join(top.where("not hot"), entry).where("class != top.class").select(*entry, *[F.col(x).alias(f"{x}_a") for x in ("own", "key", "class", "n", "left")])
    pair = (
        (F.col("class") != F.col("class_a")) & ((F.col("small") == F.col("large")) | (F.col("own") != F.col("own_a")))
        & (F.least("left", "left_a") >= share * (F.col("n") + F.col("n_a")) - SLACK)
    )
    found = a.join(entries, entry).where(pair).select(F.least("key", "key_a").alias("a"), F.greatest("key", "key_a").alias("b"))
    found = written(found.distinct(), "near-pairs")
    hot = written(entries.join(top.where("hot").select(*entry), entry, "left_semi").select("key").distinct(), "near-hot")
    if not hot.isEmpty():
        few, found = found, likely(found, entries.select("key", "class", "n").distinct(), hot, whole)
        discard(few)
    discard(now, open_, whole, shared, entries, top, hot)
    return found


def components(links: DataFrame) -> DataFrame:
    """(key, class): every key in a link with the least key of its
    connected component. Each round takes the least class among the
    neighbours, then jumps to the class of the class, so path lengths
    halve; rounds are written tables."""
    sides = F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ("ab", "ba", "aa", "bb")])
    both = written(links.select(F.explode(sides).alias("e")).select("e.*").distinct(), "near-edges")
    now = written(both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("class")), "near-classes")
    while True:
        near = both.join(now.select(F.col("key").alias("b"), F.col("class").alias("of_b")), "b")
        own = F.max(F.when(F.col("a") == F.col("b"), F.col("of_b")))
        step = written(near.groupBy(F.col("a").alias("key")).agg(F.min("of_b").alias("class"), own.alias("was")), "near-classes")
        root = step.select(F.col("key").alias("class"), F.col("class").alias("root"))
        old, now = now, written(step.join(root, "class").select("key", F.col("root").alias("class"), "was"), "near-classes")
        discard(old, step)
        if now.where("class != was").isEmpty():
            discard(both)
            return now.select("key", "class")


def leaders(members: DataFrame) -> DataFrame:
    """Per bucket, the member that shares the most buckets with others."""
    return members.groupBy("bucket").agg(F.max(F.struct("weight", "key")).alias("lead"))


def linked(docs: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(verified links (a, b) between text keys, classes (key, class) of the
    keys in a link)."""
    flat = texts.select("key", F.explode("buckets").alias("bucket"))
    sizes = written(flat.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-buckets")
    shared = written(flat.join(sizes, "bucket"), "near-shared")
    weight = shared.groupBy("key").agg(F.sum("size").alias("weight"))
    weight = written(weight, "near-weights")
    members = written(shared.select("bucket", "key").join(weight, "key"), "near-members")
    discard(sizes, shared, weight)
    every, links, of = members, None, None
    for _ in range(PASSES):
        lead = written(leaders(members), "near-leaders")
        star = members.join(lead, "bucket").select(F.col("key").alias("a"), F.col("lead.key").alias("b")).where("a != b").distinct()
        new = verified(star, docs, texts)
        if of is not None and new.isEmpty():
            break
        links = new if links is None else written(links.unionByName(new).distinct(), "near-links")
        of = components(links)
        lead_class = lead.select("bucket", F.col("lead.key").alias("key")).join(of, "key", "left").select(
            "bucket", F.coalesce("class", "key").alias("lead_class"))
        rest = members.join(of, "key", "left").withColumn("class", F.coalesce("class", "key"))
        lead_class = written(lead_class, "near-leaders")
        rest = rest.join(lead_class, "bucket").where("class != lead_class")
        done, members = members, written(rest.select("bucket", "key", "weight"), "near-members")
        discard(lead, lead_class, *[done] * (done is not every))
        if members.isEmpty():
            break
    pairs = crossing(every, of, docs, texts)
    new = verified(pairs, docs, texts)
    if not new.isEmpty():
        links = written(links.unionByName(new).distinct(), "near-links")
        of = components(links)
    discard(every, pairs)
    return links, of


def named_texts(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, id, class, n_links): one written row per distinct text."""
    links, of = linked(docs, texts)
    degree = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n_links"))
    found = texts.select("key", "id").join(of, "key", "left").join(degree, "key", "left")
    named = written(found.withColumn("class", F.coalesce("class", "key")), "near-named")
    discard(texts, links)
    return named


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links, key): one row per input row. ``class_id``
    is the smallest id in the class, ``n_links`` the verified links of the
    row's text, ``key`` the text's hash.

    Equal texts are one class, the empty text included. Texts without words
    are similar to nothing else. A null text is in a class of its own: its
    class is its own id. Rows with null ids take part; a class of such rows
    alone has a null class id. Other columns of the input are ignored."""
    d = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts_of(d)
    named = named_texts(d, texts)
    least = written(named.groupBy("class").agg(F.min("id").alias("class_id")), "near-least")
    per_text = written(named.join(least, "class").select(F.col("key").alias("k"), "class_id", "n_links"), "near-named")
    discard(named, least)
    rows = d.select("id", text_key("text").alias("key"))
    return rows.join(per_text, F.col("key") == F.col("k"), "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        "key",
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with the columns of ``docs``: of the rows
    with the class's smallest id (any id over null), one; rows with a null
    text all stay.

    The class table has a row per document without its text; the texts are
    joined to the survivors' keys once. Where several rows share the
    winning id and text, a running number picks one of them."""
    d = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts_of(d)
    named = named_texts(d, texts)
    winner = named.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("w"))
    winner = written(winner, "near-winners")
    discard(named)
    winner = winner.select(F.col("w.id").alias("wid"), F.col("w.key").alias("wkey"))
    rows = wrapped(docs, id=F.col(id_col).cast("bigint"), key=text_key(text_col))
    on = (F.col("key") == F.col("wkey")) & F.col("id").eqNullSafe(F.col("wid"))
    won = rows.where("key is not null").join(winner, on, "left_semi")
    same = Window.partitionBy("key", "id").orderBy(F.lit(0))
    one = won.withColumn("nth", F.row_number().over(same)).where("nth = 1")
    return unwrapped(one).unionByName(unwrapped(rows.where("key is null")))
