"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

Inputs of a word: hashed embeddings of the word and of its character n-grams (first four and all three- and four-byte
runs), each holding the smoothed log odds of toxic against other labelled texts.  The network (numpy, back-propagation
through time, Adam) reads windows of WINDOW words; neighbouring windows overlap by half, and every window of every
text is scored.  A logistic layer over the two largest window scores gives the score of the text.

The embeddings that a text is trained with come from the other half of the sample, so that words of one text alone
count for as little as they will in new texts.  The model is fitted on at most `most` toxic and `most` other labelled
texts, by order of a hash of doc_id, and of each label on at most MOST_BYTES of text (whole texts; one that does not fit
is passed over); labels, lang, source and doc_id are never inputs of a score.

Nulls and edges: null and blank texts get the score of a window without evidence; without both labels in the sample
all scores are the sample's toxic share (0.0 without labels); texts are read whole; repeated rows are scored alike, and
of rows with one doc_id one is trained on; an empty table gives an empty result; `score` keeps all columns under their
names but for the score's own, `scored` reads doc_id and text only."""

from __future__ import annotations

import gc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Rows, arrow_schema, bounded_batches, chunks, give_back, utf8
from .words import Words, byte_sums, mix, span_hash

WINDOW, STRIDE, MOST, MOST_BYTES = 32, 16, 2000, 32_000_000
WORD_BUCKETS, CHAR_BUCKETS, INPUTS, HIDDEN, ATTEND = 1 << 18, 1 << 16, 5, 8, 8
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_ALNUM[128:] = True


class Inputs:
    """Distinct words of some texts, with the buckets of their word and character inputs."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts, hashed=False)
        self.first, self.counts = w.first, w.counts
        s, e, buf = w.starts.copy(), w.ends.copy(), w.buf
        for _ in range(3):  # signs around a word are not part of it
            e -= (e - s > 1) & ~_ALNUM[buf[e - 1]]
            s += (e - s > 1) & ~_ALNUM[buf[s]]
        key = span_hash(byte_sums(buf), s, e)
        self.codes, distinct = pd.factorize(key)
        self.word = (distinct % np.uint64(WORD_BUCKETS)).astype(np.int64)
        at = np.zeros(len(distinct), np.int64)
        at[self.codes[::-1]] = np.arange(len(self.codes))[::-1]
        s, n = s[at], (e - s)[at]
        self.lengths = np.minimum(n, 24)
        owner = np.repeat(np.arange(len(n)), n)
        pos = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        c = buf[(s[owner] + pos)].astype(np.uint64)
        last = n[owner] - pos
        pad = np.concatenate([c, np.zeros(3, np.uint64)])
        three = (pad[:-3] << np.uint64(16)) | (pad[1:-2] << np.uint64(8)) | pad[2:-1]
        four = (three << np.uint64(8)) | pad[3:]
        grams = [(owner[m], mix(g[m] + np.uint64(salt)) % np.uint64(CHAR_BUCKETS)) for g, m, salt in ((three, last >= 3, 1 << 40), (four, last >= 4, 2 << 40), (four, (pos == 0) & (last >= 4), 3 << 40))]
        self.gram_word = np.concatenate([g[0] for g in grams])
        self.gram = np.concatenate([g[1] for g in grams]).astype(np.int64)

    def __len__(self) -> int:
        return len(self.word)

    def vectors(self, words: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """INPUTS numbers for each distinct word."""
        out = np.zeros((len(self) + 1, INPUTS), np.float32)  # the last row pads windows
        if len(self):
            odds = chars[self.gram]
            top = np.full(len(self), -1.0, np.float32)
            np.maximum.at(top, self.gram_word, odds)
            n = np.maximum(np.bincount(self.gram_word, minlength=len(self)), 1)
            out[:-1, 0] = words[self.word]
            out[:-1, 1] = top
            out[:-1, 2] = np.bincount(self.gram_word, odds, minlength=len(self)) / n
            out[:-1, 3] = self.lengths / 12.0
            out[:-1, 4] = 1.0
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Text of each window, and its words as rows of vectors(), padded with the last row; each text has one at least."""
        each = np.maximum(1, -(-(self.counts - (WINDOW - STRIDE)) // STRIDE))
        doc = np.repeat(np.arange(len(each)), each)
        step = (np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)) * STRIDE
        at = (self.first[:-1][doc] + step)[:, None] + np.arange(WINDOW)
        inside = at < self.first[1:][doc][:, None]
        codes = np.append(self.codes, len(self))
        return doc, np.where(inside, codes[np.minimum(at, len(codes) - 1)], len(self)).astype(np.int32)


def log_odds(found: list[tuple[np.ndarray, np.ndarray, bool]], which: int, size: int) -> np.ndarray:
    """Of each bucket, by how many toxic and other texts have it; found: buckets of words and n-grams of each text."""
    toxic, other, n = np.zeros(size), np.zeros(size), [1, 1]
    for row in found:
        (toxic if row[2] else other)[row[which]] += 1
        n[row[2]] += 1
    # both counts are scaled to the size of the sample before smoothing by one
    scale = min(n)
    t, o = toxic * scale / n[1], other * scale / n[0]
    return (np.log(t + 1.0) - np.log(o + 1.0)).astype(np.float32)


class Network:
    """Two directions of a gated recurrent unit, attention over their states, one output."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        h = HIDDEN
        self.w = {f"{k}{d}": v for d in "fb" for k, v in (("x", g(INPUTS, 3 * h)), ("u", g(h, 2 * h)), ("c", g(h, h)), ("b", np.zeros(3 * h, np.float32)))}
        self.w |= {"a": g(2 * h, ATTEND), "v": g(ATTEND), "o": g(2 * h), "k": np.zeros(1, np.float32)}

    def _direction(self, projected: np.ndarray, index: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (steps, windows, hidden); projected: inputs times x, plus b, of each distinct word."""
        h, steps, n = HIDDEN, index.shape[1], len(index)
        u, c = self.w[f"u{d}"], self.w[f"c{d}"]
        out = np.empty((steps, n, h), np.float32)
        state = np.zeros((n, h), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x = projected[index[:, t]]
            gates = x[:, : 2 * h] + state @ u
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, reset = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + (reset * state) @ c)
            if keep is not None:
                keep.append((t, state, z, reset, new))
            state = state + z * (new - state)
            out[t] = state
        return out

    def forward(self, vectors: np.ndarray, index: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window."""
        w = self.w
        steps = {d: [] for d in "fb"} if keep is not None else {"f": None, "b": None}
        both = np.concatenate([self._direction(vectors @ w[f"x{d}"] + w[f"b{d}"], index, d, steps[d]) for d in "fb"], 2)
        hidden = np.tanh(both @ w["a"])
        e = hidden @ w["v"]
        e -= e.max(0)
        np.exp(e, out=e)
        e /= e.sum(0)
        pooled = np.einsum("tn,tnh->nh", e, both)
        if keep is not None:
            keep |= {"steps": steps, "both": both, "hidden": hidden, "att": e, "pooled": pooled}
        return pooled @ w["o"] + w["k"][0]

    def grads(self, vectors: np.ndarray, index: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        keep: dict = {}
        w, h = self.w, HIDDEN
        logit = self.forward(vectors, index, keep)
        g = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label) / len(label)).astype(np.float32)
        out = {"o": keep["pooled"].T @ g, "k": g.sum(keepdims=True)}
        d_pool = g[:, None] * w["o"]
        both, att = keep["both"], keep["att"]
        d_both = att[:, :, None] * d_pool
        d_att = np.einsum("tnh,nh->tn", both, d_pool)
        d_e = att * (d_att - (att * d_att).sum(0))
        d_hid = d_e[:, :, None] * w["v"] * (1 - keep["hidden"] ** 2)
        out["v"] = np.einsum("tn,tna->a", d_e, keep["hidden"])
        out["a"] = np.einsum("tnh,tna->ha", both, d_hid)
        d_both = d_both + d_hid @ w["a"].T
        for k, d in enumerate("fb"):
            u, c = w[f"u{d}"], w[f"c{d}"]
            gx, gu, gc, gb = (np.zeros_like(w[f"{x}{d}"]) for x in "xucb")
            carry = np.zeros((len(index), h), np.float32)
            for t, state, z, reset, new in reversed(keep["steps"][d]):
                ds = carry + d_both[t, :, k * h : (k + 1) * h]
                dn = ds * z * (1 - new**2)
                dz = ds * (new - state) * z * (1 - z)
                back = dn @ c.T
                dr = back * state * reset * (1 - reset)
                gates = np.concatenate([dz, dr], 1)
                x = vectors[index[:, t]]
                gx += x.T @ np.concatenate([gates, dn], 1)
                gb += np.concatenate([gates, dn], 1).sum(0)
                gu += state.T @ gates
                gc += (reset * state).T @ dn
                carry = ds * (1 - z) + back * reset + gates @ u.T
            out |= {f"x{d}": gx, f"u{d}": gu, f"c{d}": gc, f"b{d}": gb}
        return out

    def fit(self, vectors: np.ndarray, index: np.ndarray, label: np.ndarray, rounds: int, size: int = 256, rate: float = 0.01, seed: int = 5) -> None:
        r = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(x) for k, x in self.w.items()} for _ in range(2))
        for it in range(1, rounds + 1):
            some = r.integers(0, len(label), min(size, len(label)))
            for k, g in self.grads(vectors, index[some], label[some]).items():
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
                self.w[k] = (self.w[k] - rate * (m[k] / (1 - 0.9**it)) / (np.sqrt(v[k] / (1 - 0.99**it)) + 1e-7)).astype(np.float32)


def top_two(doc: np.ndarray, logit: np.ndarray, n: int) -> np.ndarray:
    """Largest and second largest window logit of each text (the same for one window)."""
    order = np.lexsort((-logit, doc))
    d, x = doc[order], logit[order]
    head = np.searchsorted(d, np.arange(n))
    second = np.minimum(head + 1, len(d) - 1)
    return np.stack([x[head], np.where(d[second] == np.arange(n), x[second], x[head])], 1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias by Newton's method with a small penalty."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)) * 1e-2
        w -= np.linalg.solve(hess, x.T @ (p - y) + 1e-2 * w)
    return w


class Model:
    def __init__(self, words: np.ndarray, chars: np.ndarray, network: Network | None, top: np.ndarray, share: float):
        self.words, self.chars, self.network, self.top, self.share = words.astype(np.float16), chars.astype(np.float16), network, top, share

    def ready(self) -> Model:
        self.words, self.chars = self.words.astype(np.float32), self.chars.astype(np.float32)
        return self

    def score(self, texts: list[bytes], most: int = 4096) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.share)
        out = np.zeros(len(texts))
        for a, b in chunks([len(t) for t in texts], 500_000):
            inputs = Inputs(texts[a:b])
            vectors = inputs.vectors(self.words, self.chars)
            doc, index = inputs.windows()
            logit = np.concatenate([self.network.forward(vectors, index[k : k + most]) for k in range(0, len(index), most)])
            x = top_two(doc, logit, b - a)
            out[a:b] = 1 / (1 + np.exp(-np.clip(x @ self.top[:2] + self.top[2], -30, 30)))
        return out


def train(rows: list[tuple[str | None, int]], rounds: int = 600, seed: int = 1) -> Model:
    """rows: texts and labels."""
    rows = [((t or "").encode("utf-8", "surrogatepass"), int(y)) for t, y in rows if y is not None]
    rows.sort(key=lambda r: (zlib.crc32(r[0]), r[0], r[1]))
    labels = np.array([y for _, y in rows], np.int64)
    empty = np.zeros(1, np.float32)
    if not len(rows) or labels.min() == labels.max():
        return Model(empty, empty, None, np.zeros(3), float(labels.mean()) if len(rows) else 0.0)
    # halves with like shares of both labels
    half = np.zeros(len(rows), np.int64)
    for y in (0, 1):
        half[labels == y] = np.arange((labels == y).sum()) % 2
    found, parts = [], []
    for t, y in rows:
        i = Inputs([t])  # one text at a time, as only its distinct buckets are kept
        found.append((np.unique(i.word).astype(np.int32), np.unique(i.gram).astype(np.int32), bool(y)))
    tables = {k: tuple(log_odds([f for f, h in zip(found, half, strict=True) if h != k], w, s) for w, s in ((0, WORD_BUCKETS), (1, CHAR_BUCKETS))) for k in (0, 1, -1)}
    r = np.random.default_rng(seed)
    vectors, index, wanted, base, per_doc = [], [], [], 0, []
    for k in (0, 1):
        mine = np.flatnonzero(half == k)
        for a, b in chunks([len(rows[i][0]) for i in mine], 500_000):
            some = mine[a:b]
            inputs = Inputs([rows[i][0] for i in some])
            v = inputs.vectors(*tables[k])
            doc, win = inputs.windows()
            del inputs  # many times the size of what is kept
            evidence = np.maximum(v[win, 0], v[win, 1]).max(1) + r.random(len(win)) * 1e-3
            order = np.lexsort((-evidence, doc))
            rank = np.arange(len(order)) - np.searchsorted(doc[order], doc[order])
            toxic = labels[some][doc[order]] == 1
            # of toxic texts the windows with most evidence; of the others those too, and some of the rest
            take = order[np.where(toxic, rank < 2, (rank < 2) | (r.random(len(order)) < 0.03))]
            vectors.append(v)
            index.append(win[take] + base)
            wanted.append(labels[some][doc[take]])
            per_doc.append((some, doc, win, v))
            base += len(v)
    x, i, y = np.concatenate(vectors), np.concatenate(index), np.concatenate(wanted).astype(np.float32)
    network = Network()
    network.fit(x, i, y, rounds)
    tops, ys = [], []
    for some, doc, win, v in per_doc:
        logit = np.concatenate([network.forward(v, win[k : k + 4096]) for k in range(0, len(win), 4096)])
        tops.append(top_two(doc, logit, len(some)))
        ys.append(labels[some])
    top = _logistic(np.concatenate(tops), np.concatenate(ys))
    return Model(*tables[-1], network, top, float(labels.mean()))


def sample(docs: DataFrame, labels: DataFrame, most: int = MOST, column: str = "toxic") -> list[tuple[str | None, int]]:
    """Texts and labels: at most `most` of each label, none of them held out (2 * most rows are collected at most, and
    2 * MOST_BYTES of text)."""
    own = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    own = own.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).cast("int").alias("label")).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = [own.filter(c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in ("label = 1", "label = 0")]
    order = [r.doc_id for part in chosen for r in part.select("doc_id").collect()]
    if not order:
        return []
    spark = docs.sparkSession
    at = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    few = spark.createDataFrame([(i,) for i in order], "doc_id bigint")
    # of rows with one doc_id the longest, then the least text
    sizes = {r.doc_id: (r.n, r.th) for r in at.join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.max(F.struct(F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"), F.xxhash64("text").alias("th"))).alias("x")).select("doc_id", "x.*").collect()}
    labelled = {r.doc_id: r.label for part in chosen for r in part.collect()}
    left, ids = {0: MOST_BYTES, 1: MOST_BYTES}, []
    for i in order:
        n, th = sizes.get(i, (None, None))
        if n is not None and n <= left[labelled[i]]:
            left[labelled[i]] -= n
            ids.append((i, th, labelled[i]))
    few = spark.createDataFrame(ids, "doc_id bigint, th bigint, label int")
    texts = at.withColumn("th", F.xxhash64("text")).join(F.broadcast(few), ["doc_id", "th"]).dropDuplicates(["doc_id"])
    return [(r.text, r.label) for r in texts.select("text", "label").collect()]


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of docs with the score."""
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    rows = Rows(docs, into)
    at = rows.df.columns.index(rows.at(text))
    schema = T.StructType([*rows.df.schema.fields]).add(into, "double")

    def run(batches):
        m = sent.value
        if m.words.dtype != np.float32:
            m.ready()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(m.score(utf8(b.column(at))), pa.float64())], names=schema.names)

    return rows.back(rows.df.mapInArrow(run, schema), into)


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Model:
    model = train(sample(docs, labels, most))
    gc.collect()
    give_back()  # the driver has other work after this
    return model


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    bounded_batches(spark)
    model = fit(docs, labels)
    at = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the text goes into the worker and stays there: only doc_id and the score come back
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        if m.words.dtype != np.float32:
            m.ready()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.score(utf8(b.column(1))), pa.float64())], names=["doc_id", "score"])

    out = at.mapInArrow(run, arrow_schema("doc_id bigint, score double"))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

