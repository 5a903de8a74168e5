"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes.

The patterns (email, ip, card, phone) give the base spans.  The field is trained on a small labelled table of token
sequences and decodes every line of every text by Viterbi in numpy batches; it adds spans that the patterns do not
reach, such as telephone numbers without a plus sign, spelled-out addresses and national identity numbers.  Added
spans never touch base spans, which all stay.

Nulls and edges: a null text counts as empty and has no spans; texts and words are read whole, however long; repeated
rows repeat; an empty table gives an empty result; only doc_id and text are read, so other columns cannot clash."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, chunks

# Fixed values of the result's contract: kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), ends exclusive, in code points; each kind leftmost and without overlaps."""
    out: list[tuple[int, int, str]] = []
    floor, at = 0, text.find("@")
    while at >= 0:  # around each @, so that no long run is scanned more than once
        if m := _AT.match(text, at):
            start = at
            while start > floor and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at:
                out.append((start, m.end(), "email"))
                floor = m.end()
            at = text.find("@", m.end() if start < at else at + 1)
        else:
            floor, at = max(floor, at + 1), text.find("@", at + 1)
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    out.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return out


# --- word shapes -----------------------------------------------------------------------------------------------

#: Classes of characters: lower or other letter, upper, digit, and single signs.
LOWER, UPPER, DIGIT, OTHER = 1, 2, 3, 4
_SIGNS = {"@": 5, ".": 6, "-": 7, "+": 8, "(": 9, ")": 10, "[": 11, "]": 12, "/": 13, ":": 14, ",": 15, "_": 16}
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[ord("a") : ord("z") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("0") : ord("9") + 1] = LOWER, UPPER, DIGIT
for _c, _v in _SIGNS.items():
    _CLASS[ord(_c)] = _v
_CLASS[192:256] = LOWER
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_SHAPE_WEIGHT = np.random.default_rng(7).integers(1, 1 << 63, 32, dtype=np.uint64) | np.uint64(1)
TAGS = ("O", "email", "ip", "card", "phone", "id")
#: Words that stand for signs in spelled-out addresses; they have shapes of their own.
_SPELLED = {"at", "(at)", "[at]", "dot", "(dot)", "[dot]"}
#: Coarse classes, which neighbours see.
COARSE = 10


def shape(word: str) -> str:
    """Letters in runs as one a or A, other letters as a, digits kept as 9 each, signs as themselves."""
    if word in _SPELLED:
        return f"<{word.strip('()[]')}{'!' if word[0] in '([' else ''}>"
    out: list[str] = []
    for c in word:
        s = "9" if "0" <= c <= "9" else "A" if "A" <= c <= "Z" else c if c in _SIGNS else "a" if c.isalpha() else "*"
        if not (s in "aA*" and out and out[-1] == s):
            out.append(s)
    return "".join(out)


def coarse(s: str) -> int:
    if s[0] == "<":
        return 1 if s.startswith("<at") else 2
    n = s.count("9")
    if not n:
        return 3 if "@" in s else 0
    return 4 if n < 3 else 5 if n == 3 else 6 if n == 4 else 7 if n < 10 else 8 if n < 13 else 9


def features(s: str) -> list[str]:
    """Of one shape; the bias and what is sure to be seen again."""
    core = s.strip(".,:*") or s
    n, longest = core.count("9"), max((len(x) for x in re.findall("9+", core)), default=0)
    out = ["bias", f"coarse{coarse(s)}", f"digits{min(n, 20)}", f"run{min(longest, 20)}"]
    out += [f"has{c}{min(core.count(c), 4)}" for c in "@.-()/:_*aA" if c in core] + [f"first{core[0]}", f"last{core[-1]}"]
    if n:
        out.append("form" + re.sub("9+", lambda m: f"{len(m[0])}d", core))
    return out


# --- the field -------------------------------------------------------------------------------------------------


def labelled_rows(n: int = 600, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """The small labelled table: token sequences and a tag for each token, made from stated forms.

    Its size is `n` rows whatever the corpus; pass other rows of the same form to train on those."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeionrstldé") for _ in range(rng.randint(1, 9)))
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def plain() -> list[str]:
        kind = rng.random()
        if kind < 0.62:
            w = word()
            return [rng.choice([w, w, w.capitalize(), w + ",", w + ".", w.upper() + "!!", w + "###", w + "&&&", "|", "-", "(" + w + ")", "[" + w + "]"])]
        if kind < 0.72:
            return [rng.choice(["at", "dot", "at", "@", "a@", "(at)", word() + "." + word()])]
        return [rng.choice([num(rng.randint(1, 8)), num(rng.randint(10, 20)), f"{num(1)}.{num(1)}", f"{num(1)},{num(3)}", f"{num(4)}-{num(2)}-{num(2)}", f"{num(2)}/{num(2)}/{num(4)}", f"{num(2)}:{num(2)}", f"{num(2)}%", f"${num(2)}.{num(2)}", f"({num(3)})", f"[{num(2)}]", f"v{num(1)}.{num(1)}.{num(2)}", f"{word()}{num(2)}", f"{num(2)}-{word()}", f"{word()}_{num(3)}", f"sk-{word()}{num(6)}", f"{num(3)}-{num(2)}", f"{num(8)}{word()}{num(6)}"])]

    def found() -> tuple[list[str], str]:
        d = rng.random()
        if d < 0.3:
            a, b, c = num(3), num(3), num(4)
            return rng.choice([([f"({a})", f"{b}-{c}"], "phone"), ([f"{a}-{b}-{c}"], "phone"), ([f"{a}.{b}.{c}"], "phone"), ([f"({a}){b}-{c}"], "phone"), ([f"1-{a}-{b}-{c}"], "phone")])
        if d < 0.5:
            at, dot = rng.choice([("(at)", "(dot)"), ("[at]", "[dot]")])
            return ([word(), at, word(), dot, rng.choice(["com", "org", "net"])], "email")
        if d < 0.65:
            return ([f"{num(3)}-{num(2)}-{num(4)}"], "id")
        if d < 0.75:
            return ([f"{word()}.{num(2)}@mail{num(1)}.{word()}.com"], "email")
        if d < 0.85:
            return ([f"{num(2)}.{num(3)}.{num(2)}.{num(3)}"], "ip")
        return rng.choice([(["+1", f"({num(3)})", f"{num(3)}-{num(4)}"], "phone"), (["+" + num(2), num(3), num(3), num(4)], "phone"), ([f"{num(4)}-{num(4)}-{num(4)}-{num(4)}"], "card")])

    rows = []
    for _ in range(n):
        tokens: list[str] = []
        tags: list[str] = []
        for _ in range(rng.randint(3, 12)):
            new, tag = found() if rng.random() < 0.12 else (plain(), "O")
            tokens += new
            tags += [tag] * len(new)
        if rng.random() < 0.3 and tags[-1] not in ("O", "email"):
            tokens[-1] += rng.choice(".,")
        rows.append((tokens, tags))
    return rows


class Field:
    """Weights: of a shape's features, of the neighbours' coarse classes, of pairs of tags."""

    def __init__(self, names: dict[str, int], shapes: np.ndarray, before: np.ndarray, after: np.ndarray, moves: np.ndarray, start: np.ndarray):
        self.names, self.shapes, self.before, self.after, self.moves, self.start = names, shapes, before, after, moves, start
        #: Where O leads by more than this on every token of a line, the line's best path is O throughout: a run of other
        #: tags gains at most one entry, one exit and its inner moves over as many moves from O to O.
        stay = moves[0, 0]
        gains = [moves[1:, 1:].max() - stay, max(moves[0, 1:].max() - stay, start[1:].max() - start[0]), moves[1:, 0].max() - stay]
        self.sure = float(sum(max(0.0, g) for g in gains))

    def of_shape(self, s: str) -> np.ndarray:
        return sum((self.shapes[self.names[f]] for f in features(s) if f in self.names), np.zeros(len(TAGS), np.float32))

    def decode(self, emissions: np.ndarray) -> np.ndarray:
        """Best tags; emissions: (sequences, steps, tags), all of one length."""
        n, steps, k = emissions.shape
        best, back = emissions[:, 0] + self.start, np.zeros((steps, n, k), np.uint8)
        for t in range(1, steps):
            paths = best[:, :, None] + self.moves
            back[t] = paths.argmax(1)
            best = paths.max(1) + emissions[:, t]
        out = np.zeros((n, steps), np.uint8)
        out[:, -1] = best.argmax(1)
        rows = np.arange(n)
        for t in range(steps - 1, 0, -1):
            out[:, t - 1] = back[t, rows, out[:, t]]
        return out


def train(rows: list[tuple[list[str], list[str]]] | None = None, rounds: int = 120, rate: float = 0.08, decay: float = 1e-3) -> Field:
    """Maximum conditional likelihood by Adam, forward and backward sums over all rows at once."""
    rows = rows or labelled_rows()
    k, steps, n = len(TAGS), max(len(r[0]) for r in rows), len(rows)
    names: dict[str, int] = {}
    shp = [[shape(w) for w in r[0]] for r in rows]
    for r in shp:
        for s in r:
            for f in features(s):
                names.setdefault(f, len(names))
    hot = np.zeros((n, steps, len(names)), np.float32)
    near, here = np.zeros((n, steps, COARSE + 1), np.float32), np.zeros((n, steps, k), np.float32)
    far = np.zeros_like(near)
    valid = np.zeros((n, steps), bool)
    for i, (r, (_, tags)) in enumerate(zip(shp, rows, strict=True)):
        c = [COARSE, *[coarse(s) for s in r], COARSE]
        for t, s in enumerate(r):
            hot[i, t, [names[f] for f in features(s)]] = 1
            near[i, t, c[t]] = far[i, t, c[t + 2]] = here[i, t, TAGS.index(tags[t])] = 1
            valid[i, t] = True
    w = [np.zeros((len(names), k)), np.zeros((COARSE + 1, k)), np.zeros((COARSE + 1, k)), np.zeros((k, k)), np.zeros(k)]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    flat = [x.reshape(n * steps, -1) for x in (hot, near, far)]
    pairs = np.einsum("nta,ntb->ab", here[:, :-1], here[:, 1:])
    lse = lambda x, ax: (top := x.max(ax, keepdims=True)).squeeze(ax) + np.log(np.exp(x - top).sum(ax))
    last = valid.sum(1) - 1
    for it in range(1, rounds + 1):
        e = sum(f @ x for f, x in zip(flat, w, strict=False)).reshape(n, steps, k)
        alpha, beta = np.zeros((n, steps, k)), np.zeros((n, steps, k))
        alpha[:, 0] = e[:, 0] + w[4]
        for t in range(1, steps):
            alpha[:, t] = np.where(valid[:, t, None], lse(alpha[:, t - 1, :, None] + w[3], 1) + e[:, t], 0)
        z = lse(alpha[np.arange(n), last], 1)
        for t in range(steps - 2, -1, -1):
            beta[:, t] = np.where(valid[:, t + 1, None], lse(w[3] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2), 0)
        p = np.where(valid[..., None], np.exp(np.minimum(alpha + beta - z[:, None, None], 0)), 0)
        joint = np.where(valid[:, 1:, None, None], np.exp(np.minimum(alpha[:, :-1, :, None] + w[3] + (e + beta)[:, 1:, None, :] - z[:, None, None, None], 0)), 0).sum((0, 1))
        diff = (here - p).reshape(n * steps, k)
        grads = [f.T @ diff / n for f in flat] + [(pairs - joint) / n, (here[:, 0] - p[:, 0]).sum(0) / n]
        for j, g in enumerate(grads):
            g = g - decay * w[j]
            m[j], v[j] = 0.9 * m[j] + 0.1 * g, 0.99 * v[j] + 0.01 * g * g
            w[j] = w[j] + rate * (m[j] / (1 - 0.9**it)) / (np.sqrt(v[j] / (1 - 0.99**it)) + 1e-8)
    return Field(names, *(x.astype(np.float32) for x in w))


_SPELLED_OUT = re.compile(r"[A-Za-z0-9._%+-]+(@| ?[(\[]at[)\]] ?)[A-Za-z0-9-]+((\.| ?[(\[]dot[)\]] ?)[A-Za-z0-9-]+)+")
_NUMBER = {"phone": (7, 15), "id": (7, 12), "card": (14, 19), "ip": (4, 12)}


def sound(kind: str, text: str) -> bool:
    """Whether an added span can be what its tag says."""
    if kind == "email":
        return bool(_SPELLED_OUT.fullmatch(text))
    if kind not in _NUMBER or not text or text[-1] not in "0123456789":
        return False
    low, high = _NUMBER[kind]
    digits = re.sub("[^0-9]", "", text)
    return low <= len(digits) <= high and (kind != "card" or luhn(digits)) and (kind != "ip" or text.count(".") == 3)


class Tagger:
    """Decodes the lines of many texts; shapes seen before keep their scores."""

    def __init__(self, field: Field):
        self.field, self.seen = field, {}

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        for a, b in chunks([4 * len(t) for t in texts]):
            self._some(texts[a:b], out[a:b])
        return out

    def _some(self, texts: list[str], out: list[list]) -> None:
        joined = "\n" + "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        small = np.minimum(points, 255).astype(np.uint8)
        gap = _GAP[small]
        cls = _CLASS[small]
        flips = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        starts, ends = flips[0::2], flips[1::2]
        if not len(starts):
            return
        from .words import running, span_hash

        keep = ~gap
        keep[1:] &= ~((cls[1:] == cls[:-1]) & ((cls[1:] <= UPPER) | (cls[1:] == OTHER)) & ~gap[:-1])
        kept = np.concatenate([[0], np.cumsum(keep)])
        key = span_hash(running(_SHAPE_WEIGHT[cls[keep]]), kept[starts], kept[ends])
        spelled = (ends - starts <= 5) & ((small[starts] == 97) & (small[ends - 1] == 116) & (ends - starts == 2) | (small[starts] == 100) & (small[ends - 1] == 116) & (ends - starts == 3) | np.isin(small[starts], (40, 91)))
        for i in np.flatnonzero(spelled):  # few words look so
            if (w := joined[starts[i] : ends[i]]) in _SPELLED:
                key[i] = np.uint64(hash(w) & 0xFFFFFFFF)
        codes, distinct = pd.factorize(key)
        first = np.full(len(distinct), -1)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        for k, i in zip(distinct.tolist(), first.tolist(), strict=True):
            if k not in self.seen:
                if len(self.seen) > 200_000:
                    self.seen.clear()
                s = shape(joined[starts[i] : ends[i]])
                self.seen[k] = (self.field.of_shape(s), coarse(s))
        rows = [self.seen[k] if k in self.seen else (lambda s: (self.field.of_shape(s), coarse(s)))(shape(joined[starts[i] : ends[i]])) for k, i in zip(distinct.tolist(), first.tolist(), strict=True)]
        scores, kinds = np.array([r[0] for r in rows], np.float32)[codes], np.array([r[1] for r in rows])[codes]
        line_of = np.concatenate([[0], np.cumsum(points == 10)])[starts]
        heads = np.flatnonzero(np.concatenate([[True], line_of[1:] != line_of[:-1]]))
        lengths = np.diff(np.append(heads, len(starts)))
        before, after = np.append(COARSE, kinds[:-1]), np.append(kinds[1:], COARSE)
        before[heads] = after[heads + lengths - 1] = COARSE
        scores = scores + self.field.before[before] + self.field.after[after]
        lead = scores[:, 0] - scores[:, 1:].max(1)
        unsure = np.add.reduceat((lead <= self.field.sure).astype(np.int64), heads) > 0  # other lines are O throughout
        tags = np.zeros(len(starts), np.uint8)
        for length in np.unique(lengths[unsure]).tolist():
            at = heads[unsure & (lengths == length)]
            for some in np.array_split(at, max(1, len(at) * length // 20_000)):
                where = some[:, None] + np.arange(length)
                tags[where] = self.field.decode(scores[where])
        found = np.flatnonzero(tags)
        if not len(found):
            return
        offsets = np.cumsum([1, *[len(t) + 1 for t in texts]])
        runs = np.split(found, np.flatnonzero((np.diff(found) != 1) | (tags[found[1:]] != tags[found[:-1]]) | (line_of[found[1:]] != line_of[found[:-1]])) + 1)
        for run in runs:
            s, e, kind = int(starts[run[0]]), int(ends[run[-1]]), TAGS[tags[run[0]]]
            while e > s and joined[e - 1] in ".,;:!?\"'])":
                e -= 1
            while s < e and joined[s] in ".,;:!?\"'[":
                s += 1
            if sound(kind, joined[s:e]):
                d = int(np.searchsorted(offsets, s, "right")) - 1
                out[d].append((s - int(offsets[d]), e - int(offsets[d]), kind))


def merge(base: list[tuple[int, int, str]], added: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """All base spans and those added ones that touch none of them."""
    free = [a for a in added if all(a[1] <= s or a[0] >= e for s, e, _ in base)]
    order = {k: i for i, k in enumerate((*KINDS, "id"))}
    return sorted([*base, *free], key=lambda s: (s[0], order[s[2]]))


def joined_spans(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def find_pii(spark: SparkSession, docs: DataFrame, rows: list | None = None) -> DataFrame:
    """doc_id, base and all: arrays of (start, end, kind).  The field is trained here and sent with the tasks (some kB)."""
    field = train(rows)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches):
        tagger = Tagger(field)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            added = tagger.spans(texts)
            base = [base_spans(t) for t in texts]
            both = [merge(x, y) for x, y in zip(base, added, strict=True)]
            as_rows = lambda all_: pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in x] for x in all_], span)
            yield pa.RecordBatch.from_arrays([b.column(0), as_rows(base), as_rows(both)], names=["doc_id", "base", "spans"])

    kind = "array<struct<start:bigint,end:bigint,kind:string>>"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, arrow_schema(f"doc_id bigint, base {kind}, spans {kind}"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query: counts of base spans, digest of base spans, all spans."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
