"""Language-model scoring with a gated recurrent network in numpy.

Tokens are lower-case (A-Z) words between white space and one end per
text. All training texts are counted. The most frequent words (at most
``VOCABULARY``) are shipped to executors; a token outside them is counted
by a join.

The output softmax is factored over classes: p(word) = p(class | state) *
p(word | class, state). The ``SHORTLIST`` most frequent words form classes
of ``CLASS_SIZE`` words with a softmax inside; every other word belongs to
one of ``TAILS`` classes by its last bytes, in which it has its share of
the smoothed counts, (c + 0.5) / Z, with one unknown word per class; the
end is a class alone. Biases start at the logarithms of the counts, so the
untrained model is the smoothed unigram model.

Training is data-parallel over all training texts, each as often as it
occurs: distinct texts with their numbers of copies are dealt in portions
to workers of about ``WORKER_TOKENS`` tokens, every worker runs truncated
backpropagation over windows of ``STEPS`` tokens with the state carried on,
and the workers' weights are averaged, by a tree of sums, after each of
``ROUNDS`` rounds. Rounds take disjoint parts of the workers, which together
hold all texts, each once, at every size.

Scoring runs all texts of a batch side by side, longest first, state
carried from window to window to the end of each text, so that the whole
text is scored whatever its length and memory holds one window.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import discard, stored, text_key, written

VOCABULARY = 2**18
SHORTLIST, CLASS_SIZE = 4096, 64
BLOCKS = SHORTLIST // CLASS_SIZE
TAILS, TAIL_BYTES = 32, 2
END_CLASS = BLOCKS + TAILS
HIDDEN = 24
STEPS = 16
# Training: texts side by side, tokens per worker and round, portions of a
# worker in which copies of a text are dealt, rounds, rate.
LANES = 128
WORKER_TOKENS = 750_000
PORTIONS = 64
ROUNDS = 3
RATE = 0.08
# Workers' weights that are summed in one task, and that the driver gets at most.
FAN_IN = 8
# Output rows worked on at once, rows whose class scores fit into a core's
# cache, texts split into words at once, texts scored side by side.
ROWS = 8192
CACHED = 512
TEXTS = 1000
BLOCK_TEXTS = 512
# The end and any word of over LONG bytes are named by bytes that no word has.
END, LONG = b" ", 64
SMOOTH = 0.5


def sliced(texts: pa.Array) -> Iterator[pa.Array]:
    """``TEXTS`` texts at a time, as all their words are held at once."""
    for s in range(0, len(texts), TEXTS):
        yield texts.slice(s, TEXTS)
    pa.default_memory_pool().release_unused()


def split_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and their number in each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    words = lists.flatten().cast(pa.large_binary())
    # White space at either end of a text leaves an empty word.
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
    upto = np.append(0, np.cumsum(sizes > 0))
    words = words.filter(pa.array(sizes > 0))
    far = sizes[sizes > 0] > LONG
    if far.any():
        named = [b" " + blake2b(w, digest_size=16).digest() for w in words.filter(pa.array(far)).to_pylist()]
        words = pc.replace_with_mask(words, pa.array(far), pa.array(named, pa.large_binary()))
    return words, np.diff(upto[lists.offsets.to_numpy()])


def tail_of(word: bytes) -> int:
    return zlib.crc32(word[-TAIL_BYTES:]) % TAILS


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of each batch, the ends of its texts too."""
    for batch in batches:
        for texts in sliced(batch.column(0)):
            found = pc.value_counts(split_texts(texts)[0])
            words, n = found.field(0).cast(pa.binary()), found.field(1).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([words, n], ["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([len(texts)], pa.int64())], ["word", "n"])


class Vocabulary:
    """What the model knows of the counted words."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int, tail_mass: list[float], end_count: int):
        self.words = pa.array(words, pa.large_binary())
        m = len(words)
        c = np.array(counts + [0] * TAILS + [end_count], np.float64)
        tails = np.array([tail_of(w) for w in words] + [*range(TAILS), 0], np.int64)
        at = np.arange(m + TAILS + 1)
        short = at < min(m, SHORTLIST)
        self.end = m + TAILS
        self.first_unknown = m
        self.cls = np.where(short, at // CLASS_SIZE, BLOCKS + tails).astype(np.int32)
        self.cls[self.end] = END_CLASS
        self.inner = np.where(short, at % CLASS_SIZE, 0).astype(np.int32)
        self.inp = np.where(short, at, SHORTLIST + tails).astype(np.int32)
        self.inp[self.end] = SHORTLIST + TAILS
        self.log_count = np.log10(c + SMOOTH)
        self.known = c > 0
        # Unknown words add log10(c + 0.5) later, when their count is known.
        unknown = slice(m, m + TAILS)
        self.log_count[unknown] = 0.0
        z = np.log10(np.array(tail_mass))
        self.within = np.where(short, 0.0, self.log_count - z[tails])
        self.within[self.end] = 0.0
        self.log_total = math.log10(total + SMOOTH * (distinct + 1))
        self.total = total
        mass = np.zeros(END_CLASS + 1)
        np.add.at(mass, self.cls[short], c[short] + SMOOTH)
        mass[BLOCKS:END_CLASS] = tail_mass
        mass[END_CLASS] = end_count + SMOOTH
        self.class_bias = np.log(np.maximum(mass, 1e-3)).astype(np.float32)
        bias = np.full(SHORTLIST, -30.0, np.float32)
        bias[: int(short.sum())] = np.log(c[short] + SMOOTH)
        self.word_bias = bias.reshape(BLOCKS, CLASS_SIZE)

    def encode(self, words: list[bytes] | pa.Array) -> np.ndarray:
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.large_binary())
        ids = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).copy()
        lost = np.flatnonzero(ids < 0)
        ids[lost] = [self.first_unknown + tail_of(w) for w in words.take(pa.array(lost)).to_pylist()]
        return ids

    def encode_texts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(words of all texts, their ids, ends of the texts among them)."""
        words, n = split_texts(texts)
        return words, self.encode(words), np.cumsum(n)

    def with_ends(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts with the end behind each, and where each text begins, the last one's end too."""
        return np.insert(ids, ends, self.end), np.append(0, ends + np.arange(1, len(ends) + 1))


SHAPES = {
    "x": (SHORTLIST + TAILS + 1, 3 * HIDDEN), "h": (HIDDEN, 3 * HIDDEN), "cw": (HIDDEN, END_CLASS + 1), "cb": (END_CLASS + 1,),
    "uw": (BLOCKS, CLASS_SIZE, HIDDEN), "ub": (BLOCKS, CLASS_SIZE),
}


def start_weights(vocabulary: Vocabulary, seed: int = 11) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    w = {k: r.normal(0, 0.1 if k == "x" else 1 / math.sqrt(HIDDEN), s).astype(np.float32) for k, s in SHAPES.items()}
    w["cw"][:] = 0
    w["uw"][:] = 0
    w["cb"], w["ub"] = vocabulary.class_bias.copy(), vocabulary.word_bias.copy()
    return w


def packed(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES])


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = math.prod(s)
        out[k] = flat[at : at + n].reshape(s).copy()
        at += n
    return out


def gate_inputs(w, inputs: np.ndarray) -> np.ndarray:
    """What the input words give to the gates, (steps, 3, lanes, HIDDEN)."""
    return np.ascontiguousarray(w["x"][inputs].reshape(*inputs.shape, 3, HIDDEN).transpose(0, 2, 1, 3))


def gate_weights(w) -> np.ndarray:
    return np.ascontiguousarray(w["h"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2))


def cell(w, inputs: np.ndarray, h: np.ndarray):
    """One step of the gated unit: (new state, the gates' part of the old one)."""
    a = gate_inputs(w, inputs[None])[0]
    gh = np.empty(a.shape, a.dtype)
    return step(a, gate_weights(w), h, gh, np.empty(h.shape, a.dtype)), gh


def step(a: np.ndarray, g: np.ndarray, h: np.ndarray, gh: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``cell`` from state ``h`` into ``out``, in place: ``a`` (the inputs'
    part) becomes (keep, reset, fresh); ``g`` are the weights of the state
    and ``gh`` takes its part of the gates."""
    np.matmul(h, g, out=gh)
    gates, fresh = a[:2], a[2]
    gates += gh[:2]
    gates *= 0.5
    np.tanh(gates, out=gates)
    gates += 1
    gates *= 0.5
    np.multiply(gates[1], gh[2], out=out)
    fresh += out
    np.tanh(fresh, out=fresh)
    np.subtract(h, fresh, out=out)
    out *= gates[0]
    out += fresh
    return out


def shifted(weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, bool]:
    """Biases less the largest score that a state (within -1 and 1) can get,
    by softmax, and whether the exponentials of all scores then stay far from
    the ends of single precision, so that no row needs its own maximum.
    ``weights`` are (..., words, HIDDEN)."""
    reach = np.abs(weights) @ np.ones(HIDDEN, weights.dtype)
    most, least = (bias + reach).max(axis=-1, keepdims=True), (bias - reach).max(axis=-1, keepdims=True)
    return bias - most, bool((most - least).max() < 60)


def exps(x: np.ndarray, safe: bool) -> np.ndarray:
    """Sums of the rows' exponentials, which replace ``x``; unless it is
    ``safe``, ``x`` first loses its rows' maxima."""
    if not safe:
        x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype)


def by_class(cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(places of the tokens in shortlist classes, sorted by class; (class,
    start, end) of each class among them)."""
    places = np.flatnonzero(cls < BLOCKS)
    found = cls[places].astype(np.int16)
    order = np.argsort(found, kind="stable")
    ends = np.cumsum(np.bincount(found, minlength=BLOCKS))
    starts = np.append(0, ends[:-1])
    return places[order], [(int(k), int(starts[k]), int(ends[k])) for k in np.flatnonzero(ends > starts)]


def token_logs(w, states: np.ndarray, cls: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """log10 p(class) + log10 p(word in a shortlist class) of each token."""
    (cb, safe_c), (ub, safe_u) = shifted(w["cw"].T, w["cb"]), shifted(w["uw"], w["ub"])

    def logs(x, hits, safe):
        if not safe:
            x -= x.max(axis=1, keepdims=True)
        hit = x[np.arange(len(x)), hits].astype(np.float64)
        return hit - np.log(exps(x, True))

    out = np.empty(len(states))
    for s in range(0, len(states), CACHED):
        e = slice(s, s + CACHED)
        x = states[e] @ w["cw"]
        x += cb
        out[e] = logs(x, cls[e], safe_c)
    at, classes = by_class(cls)
    h, i, got = states[at], inner[at], np.empty(len(at))
    x = np.empty((len(at), CLASS_SIZE), states.dtype)
    for k, s, e in classes:
        np.matmul(h[s:e], w["uw"][k].T, out=x[s:e])
        x[s:e] += ub[k]
    for s in range(0, len(at), CACHED):
        e = slice(s, s + CACHED)
        got[e] = logs(x[e], i[e], safe_u)
    out[at] += got
    return out / math.log(10)


def scores(w, v: Vocabulary, texts: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each text (token ids, the end last), without
    the counts of unknown words."""
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(-lengths, kind="stable")
    total = np.zeros(len(texts))
    for s in range(0, len(texts), BLOCK_TEXTS):
        at = order[s : s + BLOCK_TEXTS]
        total[at] = block_scores(w, v, [texts[i] for i in at], lengths[at])
    return total


def block_scores(w, v: Vocabulary, texts: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    """``scores`` of texts side by side, longest first."""
    starts = np.cumsum([0, *lengths[:-1]])
    # An end before the first text, so that each token follows its input.
    flat = np.concatenate([[v.end], *texts, np.full(STEPS, v.end)]).astype(np.int32)
    total, g = np.zeros(len(texts)), gate_weights(w)
    h = np.zeros((len(texts), HIDDEN), np.float32)
    held: list = []

    def settle():
        states, ids, who = (np.concatenate(x) for x in zip(*held, strict=True))
        total[:] += np.bincount(who, weights=token_logs(w, states, v.cls[ids], v.inner[ids]) + v.within[ids], minlength=len(texts))
        held.clear()

    steps, waiting = np.arange(STEPS)[:, None], 0
    for t0 in range(0, int(lengths[0]), STEPS):
        n = int(np.searchsorted(-lengths, -t0, side="left"))  # texts longer than t0
        here = starts[:n] + t0 + steps
        now = flat[here + 1]
        before = flat[here]
        if t0 == 0:
            before[0] = v.end
        a = gate_inputs(w, v.inp[before])
        states, gh = np.empty((STEPS, n, HIDDEN), np.float32), np.empty((3, n, HIDDEN), np.float32)
        h = h[:n]
        for t in range(STEPS):
            h = step(a[t], g, h, gh, states[t])
        # Tokens of a text that ends in this window.
        real = (t0 + steps < lengths[:n]).ravel()
        held.append((states.reshape(-1, HIDDEN)[real], now.ravel()[real], np.tile(np.arange(n), STEPS)[real]))
        waiting += len(held[-1][1])
        if waiting >= ROWS:
            settle()
            waiting = 0
    if held:
        settle()
    return total


def window_gradient(w, inp: np.ndarray, cls: np.ndarray, inner: np.ndarray, mask: np.ndarray, h: np.ndarray, going: np.ndarray):
    """(gradients of the mean loss over a window of (steps, lanes) tokens,
    last state). ``going`` is 0 where a text starts, from no state."""
    parts, h = touched_gradient(w, inp, cls, inner, mask, h, going)
    g = {k: np.zeros(s, w["h"].dtype) for k, s in SHAPES.items()}
    for k, (at, d) in parts.items():
        g[k][at] = d
    return g, h


def touched_gradient(w, inp, cls, inner, mask, h, going):
    """Like ``window_gradient``, each gradient as (rows that the window
    touches, their values); all others are zero."""
    steps, lanes = inp.shape
    kind = w["h"].dtype
    gates, weights = gate_inputs(w, inp), gate_weights(w)
    on = going.astype(kind)[:, :, None]
    before, back, states = (np.empty((steps, lanes, HIDDEN), kind) for _ in range(3))
    gh = np.empty((3, lanes, HIDDEN), kind)
    for t in range(steps):
        np.multiply(h, on[t], out=before[t])
        h = step(gates[t], weights, before[t], gh, states[t])
        back[t] = gh[2]
    flat = states.reshape(-1, HIDDEN)
    c, i, m = cls.ravel(), inner.ravel(), mask.ravel().astype(kind)
    scale = m / max(1.0, m.sum())
    g, dh_out = {}, np.empty_like(flat)
    bias, safe = shifted(w["cw"].T, w["cb"])
    dcw, dcb = np.zeros((HIDDEN, END_CLASS + 1), kind), np.zeros(END_CLASS + 1, kind)
    for s in range(0, len(flat), CACHED):
        e = slice(s, s + CACHED)
        d = flat[e] @ w["cw"]
        d += bias
        d *= (scale[e] / exps(d, safe))[:, None]
        d[np.arange(len(d)), c[e]] -= scale[e]
        dcw += flat[e].T @ d
        dcb += np.ones(len(d), kind) @ d
        np.matmul(d, w["cw"].T, out=dh_out[e])
    g["cw"], g["cb"] = (slice(None), dcw), (slice(None), dcb)
    at, classes = by_class(np.where(mask.ravel(), c, END_CLASS))
    if classes:
        # Words of a class stand together, so only products go by class.
        bias, safe = shifted(w["uw"], w["ub"])
        hs, p = flat[at], np.empty((len(at), CLASS_SIZE), kind)
        for k, s, e in classes:
            np.matmul(hs[s:e], w["uw"][k].T, out=p[s:e])
            p[s:e] += bias[k]
        p *= (scale[at] / exps(p, safe))[:, None]
        p[np.arange(len(p)), i[at]] -= scale[at]
        du, dub = np.empty((len(classes), CLASS_SIZE, HIDDEN), kind), np.empty((len(classes), CLASS_SIZE), kind)
        dhs, ones = np.empty((len(at), HIDDEN), kind), np.ones(len(at), kind)
        for x, (k, s, e) in enumerate(classes):
            np.matmul(p[s:e].T, hs[s:e], out=du[x])
            np.matmul(ones[s:e], p[s:e], out=dub[x])
            np.matmul(p[s:e], w["uw"][k], out=dhs[s:e])
        dh_out[at] += dhs
        kinds = np.array([k for k, _, _ in classes]) if len(classes) < BLOCKS else slice(None)
        g["uw"], g["ub"] = (kinds, du), (kinds, dub)
    keep, reset, fresh = gates[:, 0], gates[:, 1], gates[:, 2]
    to_fresh = (1 - keep) * (1 - fresh * fresh)
    to_keep = (before - fresh) * keep * (1 - keep)
    to_reset = back * reset * (1 - reset)
    dh_out = dh_out.reshape(steps, lanes, HIDDEN)
    # Gradients of the gates as the state feeds them, and as the input does.
    dg, d_fresh = np.empty((steps, lanes, 3 * HIDDEN), kind), np.empty((steps, lanes, HIDDEN), kind)
    dh, to_state = np.zeros((lanes, HIDDEN), kind), np.ascontiguousarray(w["h"].T)
    for t in range(steps - 1, -1, -1):
        dh += dh_out[t]
        np.multiply(dh, to_keep[t], out=dg[t, :, :HIDDEN])
        np.multiply(dh, to_fresh[t], out=d_fresh[t])
        np.multiply(d_fresh[t], to_reset[t], out=dg[t, :, HIDDEN : 2 * HIDDEN])
        np.multiply(d_fresh[t], reset[t], out=dg[t, :, 2 * HIDDEN :])
        dh *= keep[t]
        dh += dg[t] @ to_state
        dh *= on[t]
    g["h"] = (slice(None), before.reshape(-1, HIDDEN).T @ dg.reshape(-1, 3 * HIDDEN))
    dg[:, :, 2 * HIDDEN :] = d_fresh
    used = inp.ravel().astype(np.int16)
    order = np.argsort(used, kind="stable")
    rows, starts = np.unique(used[order], return_index=True)
    g["x"] = (rows, np.add.reduceat(dg.reshape(-1, 3 * HIDDEN)[order], starts))
    return g, h


def fit(w, v: Vocabulary, texts: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Truncated backpropagation over the texts, which follow one another
    in ``LANES`` lanes; Adagrad."""
    # An end is both the last target of its text and the first input of the next.
    stream = np.concatenate([[v.end], *texts]).astype(np.int64)
    per = max(STEPS + 1, -(-len(stream) // LANES))
    full = np.full(LANES * per, v.end, np.int64)
    full[: len(stream)] = stream
    lane = full.reshape(LANES, per).T
    real = (np.arange(LANES * per) < len(stream)).reshape(LANES, per).T
    power = {k: np.full(s, 1e-6, np.float32) for k, s in SHAPES.items()}
    h = np.zeros((LANES, HIDDEN), np.float32)
    for s in range(0, per - 1, STEPS):
        nxt, mask = lane[s + 1 : s + 1 + STEPS], real[s + 1 : s + 1 + STEPS]
        now = lane[s : s + len(nxt)]
        if not mask.any():
            break
        g, h = touched_gradient(w, v.inp[now], v.cls[nxt], v.inner[nxt], mask, h, (now != v.end).astype(np.float32))
        for k, (at, d) in g.items():
            p = power[k][at]  # the array itself where all rows are touched
            p += d * d
            power[k][at] = p
            p = np.sqrt(p)
            np.divide(d, p, out=p)
            p *= RATE
            w[k][at] -= p
    return w


def vocabulary(counts: DataFrame, size: int) -> Vocabulary:
    """The words counted most often, at most ``size``: those above the
    least count level that leaves room for all of its words."""
    end_count = counts.where(F.col("word") == F.lit(END)).agg(F.sum("n")).first()[0] or 0
    words = counts.where(F.col("word") != F.lit(END))
    level = F.floor(F.log2("n") * 16).cast("int")
    taken, least = 0, None
    for r in words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("level")).collect():
        taken += r["k"]
        if taken > size:
            break
        least = r["level"]
    top = [] if least is None else words.where(level >= least).collect()
    top = sorted(((int(r["n"]), bytes(r["word"])) for r in top), key=lambda x: (-x[0], x[1]))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tail = F.crc32(F.expr(f"substring(word, greatest(length(word) - {TAIL_BYTES - 1}, 1), {TAIL_BYTES})")) % TAILS
    mass = [SMOOTH] * TAILS
    for r in words.groupBy(tail.alias("t")).agg((F.sum("n") + SMOOTH * F.count(F.lit(1))).alias("z")).collect():
        mass[int(r["t"])] += r["z"]
    for n, w in top[:SHORTLIST]:
        mass[tail_of(w)] -= n + SMOOTH
    return Vocabulary([w for _, w in top], [n for n, _ in top], total, distinct, mass, end_count)


def deal(texts: DataFrame, workers: int) -> DataFrame:
    """(ids, copies, worker) of texts (ids, copies): the copies of a text go
    to the workers in portions of about 1/``PORTIONS`` of ``WORKER_TOKENS``,
    so that no number of copies can fill one of them."""
    most = F.greatest(F.lit(1), F.expr(f"{WORKER_TOKENS // PORTIONS} div size(ids)"))
    d = texts.withColumn("most", most).withColumn("nth", F.explode(F.expr("sequence(0, (copies - 1) div most)")))
    worker = F.pmod(F.xxhash64("ids", "nth"), F.lit(workers)).cast("int")
    return d.select("ids", F.least("most", F.expr("copies - nth * most")).cast("int").alias("copies"), worker.alias("worker"))


def mean(tokens, weights) -> np.ndarray:
    """Mean of single-precision weights, each counted by its tokens."""
    total = np.zeros(1)
    for n, w in zip(tokens, weights, strict=True):
        total = total + n * np.frombuffer(w, np.float32).astype(np.float64)
    return (total / sum(tokens)).astype(np.float32)


def train(sample: DataFrame, v: Vocabulary, shipped) -> np.ndarray:
    """Weights after ``ROUNDS`` rounds of workers on ``sample`` (text)."""
    sc = sample.sparkSession.sparkContext
    flat = packed(start_weights(v))

    def encoded(batches):
        for batch in batches:
            for texts in sliced(batch.column(0)):
                _, ids, ends = shipped.value.encode_texts(texts)
                ids, at = shipped.value.with_ends(ids, ends)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))], ["ids"])

    texts = written(sample.mapInArrow(encoded, "ids array<int>").groupBy("ids").agg(F.count(F.lit(1)).alias("copies")), "lm-texts")
    tokens = texts.agg(F.sum(F.size("ids") * F.col("copies"))).first()[0] or 0
    if not tokens:
        return flat
    workers = ROUNDS * -(-tokens // (ROUNDS * WORKER_TOKENS))
    dealt = deal(texts, workers)

    def learn(f: pd.DataFrame) -> pd.DataFrame:
        ids = [(np.asarray(x, np.int32), k) for x, n in zip(f["ids"], f["copies"], strict=True) for k in range(n)]
        ids = [x for x, _ in sorted(ids, key=lambda x: (zlib.crc32(x[0].tobytes(), x[1]), len(x[0])))]
        got = fit(unpacked(weights.value), shipped.value, ids)
        n = float(sum(map(len, ids)))
        return pd.DataFrame({"worker": [int(f["worker"].iloc[0])], "n": [n], "w": [packed(got).tobytes()]})

    def summed(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("worker")
        return pd.DataFrame({"worker": [int(f["g"].iloc[0])], "n": [float(f["n"].sum())], "w": [mean(f["n"], f["w"]).tobytes()]})

    for r in range(ROUNDS):
        weights = sc.broadcast(flat)
        learned = dealt.where(F.col("worker") % ROUNDS == r).groupBy("worker").applyInPandas(learn, "worker int, n double, w binary")
        part, left = learned, workers
        while True:  # sums of FAN_IN, of those FAN_IN, ... until few are left
            part = part.withColumn("g", F.floor(F.col("worker") / FAN_IN).cast("int")).groupBy("g").applyInPandas(
                summed, "worker int, n double, w binary")
            left = -(-left // FAN_IN)
            if left <= FAN_IN:
                break
        rows = sorted(part.collect(), key=lambda r: r["worker"])
        if rows:
            flat = mean([x["n"] for x in rows], [x["w"] for x in rows])
        weights.unpersist()
    discard(texts)
    return flat


def scorer(vocab, weights):
    """Column function: what a text's tokens give before the counts of the
    words outside the shipped vocabulary are known, and those words."""

    @F.pandas_udf("struct<n:bigint,known:bigint,base:double,score:double,rest:array<struct<word:binary,tf:int>>>")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v, w = vocab.value, unpacked(weights.value)
        for s in texts:
            ids, rest = [], []
            for texts in sliced(pa.array(s, pa.string())):
                words, found, ends = v.encode_texts(texts)
                far = np.flatnonzero(found >= v.first_unknown)
                names, cuts = words.take(pa.array(far)).to_pylist(), np.searchsorted(far, np.append(0, ends))
                for a, b in zip(cuts, cuts[1:], strict=False):
                    rest.append([{"word": k, "tf": n} for k, n in sorted(Counter(names[a:b]).items())])
                flat, at = v.with_ends(found, ends)
                ids += np.split(flat, at[1:-1])
            yield pd.DataFrame({
                "n": [len(x) for x in ids],
                "known": [int(v.known[x].sum()) for x in ids],
                "base": [float(v.log_count[x].sum()) - len(x) * v.log_total for x in ids],
                "score": scores(w, v, ids) if ids else [],
                "rest": rest,
            })

    return score


def score_texts(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, n_tokens, n_known, train_tokens, base_score, score), one row
    per input row, learned from the texts of ``training``.

    A null text counts as empty: its only token is the end. Repeated rows
    get equal scores and count as often as they occur in training. Without
    training rows every word is unknown and the scores are those of the
    smoothed empty counts. Other columns of the input are ignored."""
    sc = docs.sparkSession.sparkContext
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    learn = training.select(text)
    counts = stored(learn.mapInArrow(counted, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    v = vocabulary(counts, VOCABULARY)
    vocab = sc.broadcast(v)
    weights = sc.broadcast(train(learn, v, vocab))
    rows = docs.select(F.col(id_col).alias("id"), text).withColumn("key", text_key("text"))
    got = written(rows.select("id", "key", scorer(vocab, weights)(F.col("text")).alias("got")), "lm-scores")
    rest = got.select("id", "key", F.explode("got.rest").alias("r")).select("id", "key", "r.word", "r.tf")
    late = (
        rest.join(counts, "word", "left").groupBy("id", "key")
        .agg(F.sum(F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("late"),
             F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("late_known"))
    )
    # Rows that agree in id and text have put their words in twice.
    copies = got.groupBy("id", "key").agg(F.count(F.lit(1)).alias("copies"))
    late = late.join(copies, late["id"].eqNullSafe(copies["id"]) & (late["key"] == copies["key"])).select(
        late["id"].alias("lid"), late["key"].alias("lkey"), (F.col("late") / F.col("copies")).alias("late"),
        F.expr("late_known div copies").alias("late_known"))
    both = got.join(late, got["id"].eqNullSafe(F.col("lid")) & (got["key"] == F.col("lkey")), "left")
    more = F.coalesce("late", F.lit(0.0))
    return both.select(
        "id", "key", F.col("got.n").alias("n_tokens"), (F.col("got.known") + F.coalesce("late_known", F.lit(0))).alias("n_known"),
        F.lit(int(v.total)).cast("bigint").alias("train_tokens"), (F.col("got.base") + more).alias("base_score"),
        (F.col("got.score") + more).alias("score"))
