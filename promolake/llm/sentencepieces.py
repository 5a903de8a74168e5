"""SentencePiece encoding and decoding.

Pieces and scores come from a model file (its path is a parameter).  A text is segmented by Viterbi: the best path over
the lattice of pieces, which a double-array trie over UTF-8 bytes enumerates.  A character that no piece covers counts
as unknown and is written as its bytes' pieces.  Decoding joins the pieces, turns whitespace markers into spaces and
drops the leading marker that encoding adds, so every text comes back unchanged: a marker character in the text itself
is written as bytes.

No piece reaches over the start of a word, so a text falls into units that part exactly.  The distinct units of some
texts (a bounded number of bytes) are encoded at once: the trie is walked from all their characters in step, then the
best paths are extended by one byte for all units at a time.  Nothing is kept from one such part to the next.

A file of unigram type has log probabilities as scores, which are used as they are.  A file of merge type has merge
ranks; they are read as Zipf's law, log p = -log(rank + 2.7) - log H, so that longer and earlier pieces win.

Nulls and edges: a null or empty text has no pieces and decodes to an empty one; texts are encoded whole, however long;
repeated rows repeat; an empty table gives an empty result; a column of the input that has the name of a result's
column gives way to it, all others are kept.  Ids that are not known, or null, decode to nothing, and bytes that are no
UTF-8 to replacement characters."""

from __future__ import annotations

import hashlib
import math
import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Rows, arrow_schema, bounded_batches, chunks, factorize, parts
from .words import byte_sums, span_hash

MARKER = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: What an unknown character costs beyond the least score.
UNKNOWN_PENALTY = 10.0
#: Scores are kept as whole multiples of 1 / FIXED.
FIXED = 1 << 24
_NOT_REACHED = -(1 << 62)
#: Bytes of text whose units are segmented together; the paths take some hundred times as much.
PART_BYTES = 1_000_000
#: Longer units (in bytes) are so few that each is segmented by itself.
LONG_UNIT = 1024


def _fields(data: bytes):
    """(number, value) of a protocol-buffer message; values: int, or bytes of fixed and length-delimited fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = out = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        n = varint() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, data[at : at + n]
        at += n


def read_model(data: bytes) -> tuple[list[tuple[str, float, int]], bool]:
    """Pieces (text, score, type) of a model file, and whether its scores are log probabilities."""
    pieces, unigram = [], True
    for number, value in _fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for k, v in _fields(value):
                if k == 1:
                    text = v.decode()
                elif k == 2:
                    score = struct.unpack("<f", v)[0]
                elif k == 3:
                    kind = v
            pieces.append((text, score, kind))
        elif number == 2:
            unigram = dict(_fields(value)).get(3, 1) == 1
    return pieces, unigram


class DoubleArray:
    """Trie over bytes: the child of node s for byte c is t = base[s] + c if check[t] == s; value[s] is a piece or -1."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        keys = sorted(keys)
        size = 4096
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        self.check[0] = 0
        free = top = 256
        todo = [(0, 0, len(keys), 0)]
        while todo:
            node, lo, hi, depth = todo.pop()
            if lo < hi and len(keys[lo][0]) == depth:
                self.value[node] = keys[lo][1]
                lo += 1
            children = []
            while lo < hi:
                c, first = keys[lo][0][depth], lo
                while lo < hi and keys[lo][0][depth] == c:
                    lo += 1
                children.append((c, first, lo))
            if not children:
                continue
            while free < len(self.check) and self.check[free] >= 0:
                free += 1
            slot, offsets = free, [c - children[0][0] for c, _, _ in children]
            for _ in range(40):  # a few free slots from the front, then behind all that is used
                if slot >= top or slot > children[0][0] and all(self.check[slot + o] < 0 for o in offsets):
                    break
                slot += 1
                while slot < top and self.check[slot] >= 0:
                    slot += 1
            else:
                slot = top
            b = max(1, max(slot, top if slot <= children[0][0] else 0) - children[0][0])
            top = max(top, b + children[-1][0] + 1)
            while top + 512 > len(self.check):
                more = len(self.check)
                self.base += [0] * more
                self.check += [-1] * more
                self.value += [-1] * more
            self.base[node] = b
            for c, first, last in children:
                self.check[b + c] = node
                todo.append((b + c, first, last, depth + 1))


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (n[0] numbers), first[1], ..."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


#: Bytes of a character by its first byte; none starts with a continuation byte.
_WIDTH = np.ones(256, np.int64)
_WIDTH[0xC0:0xE0], _WIDTH[0xE0:0xF0], _WIDTH[0xF0:] = 2, 3, 4


class Encoded:
    """Of some texts: ids of all, one after the other; first: index of each text's first id, with a last entry."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, by_byte: np.ndarray):
        self.ids, self.first, self.by_byte = ids, first, by_byte

    def as_lists(self) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(self.first.astype(np.int32)), pa.array(self.ids))


class Pieces:
    """A vocabulary, ready to encode and decode; small enough to be sent with every task (about 2 MB)."""

    def __init__(self, pieces: list[tuple[str, float, int]], unigram: bool):
        # a space in a text is always a marker, so a piece with a space of its own can never match
        usable = [(i, t, s) for i, (t, s, k) in enumerate(pieces) if k in (NORMAL, USER) and t and " " not in t]
        if unigram:
            scores = {i: s for i, _, s in usable}
        else:
            total = math.log(sum(1 / (-s + 2.7) for _, _, s in usable))
            scores = {i: -math.log(-s + 2.7) - total for i, _, s in usable}
        # spaces stand for markers in the trie; a marker of the text is then covered by no piece
        trie = DoubleArray([(t.replace(MARKER, " ").encode(), i) for i, t, _ in usable])
        self.base, self.check, self.value = (np.array(x, np.int32) for x in (trie.base, trie.check, trie.value))
        #: By id, in fixed point, so that equal paths tie wherever they stand; the last one is of unknown characters.
        unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.score = np.rint(np.array([*[scores.get(i, 0.0) for i in range(len(pieces))], unknown]) * FIXED).astype(np.int64)
        byte = {int(t[3:5], 16): i for i, (t, _, k) in enumerate(pieces) if k == BYTE}
        self.has_bytes = len(byte) == 256
        self.byte = np.array([byte.get(b, 0) for b in range(256)], np.int32)
        self.unk = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        self.is_byte = np.array([k == BYTE for _, _, k in pieces])
        #: What each id adds to the decoded bytes.
        out = [t.replace(MARKER, " ").encode() if k in (NORMAL, USER) else bytes([int(t[3:5], 16)]) if k == BYTE else b"" for t, _, k in pieces]
        self.out = np.frombuffer(b"".join(out), np.uint8)
        self.out_size = np.array([len(x) for x in out], np.int64)
        self.out_first = np.cumsum(self.out_size) - self.out_size
        #: Where no piece crosses from a word to a following space or holds a line feed, such units part exactly.
        self.apart = all(MARKER not in t.lstrip(MARKER) and "\n" not in t for _, t, _ in usable)

    def edges(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All edges of the lattices of units: place of the first byte, length, id (the last score's for unknown ones)."""
        end = np.repeat(first + size, size)
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        if (data[first] & 0xC0 == 0x80).any():  # no UTF-8; a unit starts anyhow
            starts = np.union1d(starts, first)
        end = end[starts]
        width = np.minimum(_WIDTH[data[starts]], end - starts)
        single = np.zeros(len(starts), bool)
        at, node, depth = np.arange(len(starts)), np.zeros(len(starts), np.int32), 0
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(at):
            child = self.base[node] + data[starts[at] + depth]
            ok = (self.check[child] == node) & (child > 0)
            at, node, depth = at[ok], child[ok], depth + 1
            piece = self.value[node]
            hit = piece >= 0
            own = at[hit]
            found.append((starts[own], np.full(len(own), depth), piece[hit]))
            single[own[width[own] == depth]] = True
            more = starts[at] + depth < end[at]
            at, node = at[more], node[more]
        lone = np.flatnonzero(~single)
        found.append((starts[lone], width[lone], np.full(len(lone), len(self.score) - 1)))
        return tuple(np.concatenate([f[k] for f in found]) for k in range(3))

    def best_paths(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the units' best paths, one after the other, and their number for each unit.

        Of paths with equal scores it is the one whose last piece starts first, and so on backwards."""
        place, length, piece = self.edges(data, first, size)
        unit = np.repeat(np.arange(len(first)), size)[place]
        offset = place - first[unit]
        order = np.argsort(offset, kind="stable")
        cuts = np.searchsorted(offset[order], np.arange(int(size.max()) + 1))
        # a unit of n bytes has n + 1 nodes
        start = (place + unit)[order]
        stop, piece = start + length[order], piece[order]
        gain = self.score[piece]
        best, via, back = np.full(len(data) + len(first), _NOT_REACHED), np.zeros(len(data) + len(first), np.int32), np.zeros(len(data) + len(first), np.int64)
        best[first + np.arange(len(first))] = 0
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            # edges from one node end at different nodes, so nothing is written twice
            reached, to = best[start[a:b]] + gain[a:b], stop[a:b]
            good = np.flatnonzero((reached > best[to]) & (best[start[a:b]] > _NOT_REACHED))
            to = to[good]
            best[to], via[to], back[to] = reached[good], piece[a:b][good], start[a:b][good]
        root = first + np.arange(len(first))
        now, who = root + size, np.arange(len(first))
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(who):
            before = back[now]
            steps.append((who, now, before))
            go = before > root[who]
            now, who = before[go], who[go]
        who, now, before = (np.concatenate([s[k] for s in reversed(steps)]) for k in range(3))
        order = np.argsort(who, kind="stable")
        who, now, before = who[order], now[order], before[order]
        ids, wide = via[now].astype(np.int32), now - before
        lost = ids == len(self.score) - 1
        n = np.where(lost & self.has_bytes, wide, 1)
        out = np.repeat(np.where(lost, self.unk, ids), n).astype(np.int32)
        if self.has_bytes and lost.any():
            out[np.repeat(lost, n)] = self.byte[data[spread((before - who)[lost], wide[lost])]]
        return out, np.bincount(who, n, minlength=len(first)).astype(np.int64)

    def alone(self, data: bytes) -> np.ndarray:
        """The same for one long unit, byte by byte; 20 bytes of memory for each of its bytes."""
        base, check, value, score = self.base, self.check, self.value, self.score
        n = len(data)
        best, back, piece = array("q", [_NOT_REACHED]) * (n + 1), array("q", [0]) * (n + 1), array("i", [-1]) * (n + 1)
        best[0] = 0
        last = len(score) - 1
        for at in range(n):
            here = best[at]
            if here == _NOT_REACHED:
                continue
            node, end, single, width = 0, at, False, int(_WIDTH[data[at]])
            while end < n:
                child = int(base[node]) + data[end]
                if check[child] != node or not child:
                    break
                node, end = child, end + 1
                p = int(value[node])
                if p >= 0:
                    single |= end - at == width
                    if (reached := here + int(score[p])) > best[end]:
                        best[end], back[end], piece[end] = reached, at, p
            if not single:
                end = min(at + width, n)
                if (reached := here + int(score[last])) > best[end]:
                    best[end], back[end], piece[end] = reached, at, last
        out: list[np.ndarray] = []
        end = n
        while end:
            at, p = back[end], piece[end]
            out.append(np.array([p], np.int32) if p != last else self.byte[np.frombuffer(data[at:end], np.uint8)] if self.has_bytes else np.array([self.unk], np.int32))
            end = at
        return np.concatenate(out[::-1])

    def _distinct(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids of distinct units, index of each unit's first id, and their number."""
        long = np.flatnonzero(size > LONG_UNIT)
        short = np.flatnonzero(size <= LONG_UNIT)
        n, out = np.zeros(len(first), np.int64), [np.empty(0, np.int32)]
        place = np.zeros(len(first), np.int64)
        if len(short):
            own = size[short]
            ids, n[short] = self.best_paths(data[spread(first[short], own)], np.cumsum(own) - own, own)
            place[short] = np.cumsum(n[short]) - n[short]
            out.append(ids)
        at = len(out[-1])
        for k in long.tolist():
            ids = self.alone(data[first[k] : first[k] + size[k]].tobytes())
            n[k], place[k] = len(ids), at
            at += len(ids)
            out.append(ids)
        return np.concatenate(out), place, n

    def encode_all(self, texts: list[bytes]) -> Encoded:
        data = np.frombuffer(b"".join([b" " + t for t in texts if t]), np.uint8)
        if not len(data):
            return Encoded(np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64), np.zeros(len(texts), np.int64))
        size = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        begin = np.cumsum(size) - size
        head = np.zeros(len(data), bool)
        if self.apart:
            # at a line feed and after it, and where spaces begin
            feed, space = data == 10, data == 32
            head[1:] = feed[1:] | feed[:-1] | (space[1:] & ~space[:-1])
        head[begin[size > 0]] = True
        first = np.flatnonzero(head)
        length = np.diff(np.append(first, len(data)))
        codes, distinct = factorize(span_hash(byte_sums(data), first, first + length))
        sample = np.zeros(len(distinct), np.int64)
        sample[codes[::-1]] = np.arange(len(codes))[::-1]
        ids, place, n = self._distinct(data, first[sample], length[sample])
        of_unit = n[codes]
        out = ids[spread(place[codes], of_unit)]
        owner = np.searchsorted(begin + size, first, "right")
        per = np.bincount(owner, of_unit, minlength=len(texts)).astype(np.int64)
        firsts = np.concatenate([[0], np.cumsum(per)])
        by_byte = np.concatenate([[0], np.cumsum(self.is_byte[out])])
        return Encoded(out, firsts, by_byte[firsts[1:]] - by_byte[firsts[:-1]])

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text as 32-bit numbers."""
        return self.encode_all([text.encode("utf-8", "surrogatepass")]).ids

    def decode_all(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        """Bytes of each text, whose ids start at `first` (with a last entry)."""
        known = (ids >= 0) & (ids < len(self.out_size))
        safe = np.where(known, ids, 0)
        n = np.where(known, self.out_size[safe], 0)
        raw = self.out[spread(self.out_first[safe], n)].tobytes()
        ends = np.concatenate([[0], np.cumsum(n)])[first].tolist()
        # encoding puts a space before each text
        return [raw[a + (raw[a : a + 1] == b" ") : b] if a < b else b"" for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        return self.decode_all(ids, np.array([0, len(ids)]))[0].decode("utf-8", "replace")


def load(spark: SparkSession, path: str = DEFAULT_MODEL) -> Pieces:
    """Reads the model file where it is installed on the driver, or else through Spark (other stores)."""
    if "://" in path:
        data = bytes(spark.read.format("binaryFile").load(path).first().content)
    else:
        with open(path, "rb") as f:
            data = f.read()
    return Pieces(*read_model(data))


_TOKENS = (("ids", T.ArrayType(T.IntegerType())), ("n_tokens", T.LongType()), ("n_byte_pieces", T.LongType()))


def encode(spark: SparkSession, docs: DataFrame, model: str = DEFAULT_MODEL, text: str = "text", back: bool = False) -> DataFrame:
    """All columns of docs with ids (array of int), n_tokens and n_byte_pieces; with `back`, the text is what the ids
    decode to, by the same worker."""
    bounded_batches(spark)
    pieces = spark.sparkContext.broadcast(load(spark, model))
    rows = Rows(docs, *[n for n, _ in _TOKENS])
    at = rows.df.columns.index(rows.at(text))
    schema = T.StructType([T.StructField(f.name, T.StringType() if back and k == at else f.dataType) for k, f in enumerate(rows.df.schema)])
    for name, kind in _TOKENS:
        schema = schema.add(name, kind)

    def run(batches):
        p = pieces.value
        for b in batches:
            for i, j, texts in parts(b.column(at), PART_BYTES):
                found = p.encode_all(texts)
                cols = [c.slice(i, j - i) for c in b.columns]
                if back:
                    cols[at] = pa.array([t.decode("utf-8", "replace") for t in p.decode_all(found.ids, found.first)], pa.string())
                more = [found.as_lists(), pa.array(np.diff(found.first)), pa.array(found.by_byte.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*cols, *more], names=schema.names)

    return rows.back(rows.df.mapInArrow(run, schema), *[n for n, _ in _TOKENS])


def decode(spark: SparkSession, encoded: DataFrame, model: str = DEFAULT_MODEL, into: str = "decoded", ids: str = "ids") -> DataFrame:
    """All columns of encoded with the text of its ids."""
    bounded_batches(spark)
    pieces = spark.sparkContext.broadcast(load(spark, model))
    rows = Rows(encoded, into)
    at = rows.df.columns.index(rows.at(ids))
    schema = T.StructType([*rows.df.schema.fields]).add(into, "string")

    def run(batches):
        p = pieces.value
        for b in batches:
            lists = b.column(at)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in chunks((4 * sizes).tolist()):
                flat = lists.slice(i, j - i).flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                texts = p.decode_all(flat, np.concatenate([[0], np.cumsum(sizes[i:j])]))
                cols = [c.slice(i, j - i) for c in b.columns]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], names=schema.names)

    return rows.back(rows.df.mapInArrow(run, schema), into)


def digest(spark: SparkSession, docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id, n_tokens, n_byte_pieces, ids_sha256 (of the ids as little-endian 32-bit numbers), round_trip."""
    bounded_batches(spark)
    pieces = spark.sparkContext.broadcast(load(spark, model))

    def run(batches):
        p = pieces.value
        for b in batches:
            for i, j, texts in parts(b.column(1), PART_BYTES):
                found = p.encode_all(texts)
                ids, cuts = found.ids.astype("<i4", copy=False), found.first.tolist()
                sha = [hashlib.sha256(ids[x:y]).hexdigest() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                same = [x == y for x, y in zip(p.decode_all(ids, found.first), texts, strict=True)]
                cols = [pa.array(np.diff(found.first)), pa.array(found.by_byte.astype(np.int64)), pa.array(sha, pa.string()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *cols], names=["doc_id", "n_tokens", "n_byte_pieces", "ids_sha256", "round_trip"])

    at = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return at.mapInArrow(run, arrow_schema("doc_id bigint, n_tokens bigint, n_byte_pieces bigint, ids_sha256 string, round_trip boolean"))
