"""Every operator against a brute-force version on small tables with nulls, blanks, ties, copies and long texts."""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex

from promolake.llm import decontamination, host_rules, jaccard_join, line_dedup, pii, resampling, sentencepieces, suffix_runs, suffix_tree, toxicity, words
from promolake.llm.components import components
from promolake.llm.common import Shelf

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def make(spark, texts, source="s"):
    rows = [(i, t, "en", f"{source}{(i or 0) % 3}", None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def vocabulary(rng, n=400):
    return ["".join(rng.choice("abdeinorst") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def prose(rng, vocab, n):
    out = []
    for k in range(n):
        w = rng.choice(vocab)
        out.append(w.capitalize() if rng.random() < 0.1 else w + "." if rng.random() < 0.05 else w)
        if rng.random() < 0.03:
            out[-1] += "\n"
    return re.sub("\n ", "\n", " ".join(out))


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies, shared passages, nulls, blanks, signs of all widths and one long text."""
    rng = random.Random(5)
    vocab = vocabulary(rng)
    texts = [prose(rng, vocab, rng.randint(1, 250)) for _ in range(60)]
    passage = prose(rng, vocab, 70)
    base = prose(rng, vocab, 200)
    for k in range(14):
        w = base.split(" ")
        for _ in range(k % 5 * 2):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(" ".join(w))
    texts += [t + " " + passage + " " + u for t, u in zip(texts[:6], texts[6:12], strict=True)]
    texts += [texts[0], texts[0], texts[3], None, "", " \t\n", "a", "a b", "A  b", "é漢\U0001f600 ▁ x", "ab" * 400, "x" * 900, prose(rng, vocab, 5000)]
    short = prose(rng, vocab, 21).replace("\n", " ").split(" ")
    texts += [" ".join(short[:n]) for n in (11, 12, 13, 18, 19, 20, 21)]
    rows = list(enumerate(texts))
    rows += [rows[2], rows[2], (None, texts[5]), (None, None), (7, texts[9])]
    return rows


# --- words -----------------------------------------------------------------------------------------------------


def test_words_and_shingles(corpus):
    texts = [(t or "").encode() for _, t in corpus]
    w = words.Words(texts)
    expected = [WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)})) for _, t in corpus]
    assert w.counts.tolist() == [len(x) for x in expected]
    flat = [x for e in expected for x in e]
    assert [w.buf[s:e].tobytes().decode() for s, e in zip(w.starts, w.ends, strict=True)] == flat
    assert len(set(zip(w.hash.tolist(), flat, strict=True))) == len(set(w.hash.tolist())) == len(set(flat))
    doc, h = words.shingles(w, 3)
    own = [tuple(e[k : k + 3]) for e in expected for k in range(max(1, len(e) - 2)) if e]
    assert len(own) == len(h) and len(set(zip(own, h.tolist(), strict=True))) == len(set(own)) == len(set(h.tolist()))


# --- 1: decontamination ----------------------------------------------------------------------------------------


_JAVA_SPACE, _LOWER_RUN = re.compile(r"[ \t-\r]+"), regex.compile(r"(?<![\p{L}\p{N}])(\p{Lu}\p{Ll}+) (?=\p{Lu}\p{Ll})")


def _plain_template(text, names=True, tie=True):
    """(typed words, words) by plain code: a loop over words."""
    spaced = _JAVA_SPACE.sub(" ", text)
    words = (_LOWER_RUN.sub("\\1⁀", spaced) if tie else spaced).split(" ")
    words = [w for w in words if w]
    out = []
    for k, w in enumerate(words):
        if names:
            w = regex.sub(r"(?<![\p{L}\p{N}⁀])\p{Lu}\p{Ll}+(⁀\p{Lu}\p{Ll}+)*", "⟨name⟩", w)
        w = regex.sub(r"(?<![^\s(\[$€£+\-])[$€£]?[+\-]?[0-9]+([.,:/][0-9]+)*%?", "⟨num⟩", w)
        if k and out[-1].endswith("⟨num⟩"):
            unit = next((u for u in sorted(decontamination.UNITS, key=len, reverse=True) if w.lower().startswith(u) and not regex.match(r"[\p{L}\p{N}]", w[len(u) : len(u) + 1] or " ")), None)
            w = "⟨unit⟩" + w[len(unit) :] if unit else w
        out.append(w)
    return [w.lower() for w in out], [w.lower() for w in words]


def _plain_held(text, item, share=0.5, slack=3, size=8, least=4):
    """Whether a document holds an item: all windows against all windows."""
    if text is None or not _plain_template(item)[1]:
        return False
    forms, telling = [], lambda win: sum(regex.sub(r"[^\p{L}\p{N}⟨⟩]", "", w) not in ("⟨num⟩", "⟨unit⟩", "⟨name⟩") for w in win) >= least
    for names in (True, False):
        form, words = _plain_template(item if names else item.lower(), names)
        forms.append((form, words, *_plain_template(text), [a for a in range(len(form) - size + 1) if telling(form[a : a + size])], size))
    if not any(f[4] for f in forms):
        w, said = ([x.lower() for x in _JAVA_SPACE.sub(" ", t).split(" ") if x] for t in (item, text))
        n = min(size, len(w))
        forms = [(w, w, said, said, list(range(len(w) - n + 1)), n)]
    for form, asked, doc_form, doc_words, ats, n in forms:
        at = defaultdict(set)
        for p in range(len(doc_form) - n + 1):
            for a in ats:
                if doc_form[p : p + n] == form[a : a + n]:
                    at[p - a].add(a)
        for shift in at:
            pairs = {(a, s) for s in at if abs(s - shift) <= slack for a in at[s]}
            if not ats or len({a for a, _ in pairs}) < share * len(ats):
                continue
            filled = set()
            for a, s in pairs:
                for p in range(a, a + n):
                    if 0 < p < len(form) - 1 and (m := re.search("⟨(num|unit|name)⟩", form[p])):
                        filled.add((m[1], asked[p], doc_words[p + s]))
            named = [f for f in filled if f[0] == "name"]
            if len({f[:2] for f in filled}) == len(filled) and len({f[1] for f in named}) == len({f[2] for f in named}):
                return True
    return False


def test_decontamination(spark):
    rng = random.Random(9)
    vocab = vocabulary(rng)
    items = [(k, prose(rng, vocab, 25).replace("\n", " ")) for k in range(5)]
    items.append((5, "Maria bought 12 red apples and 7 green pears, then gave 12 apples to Jonas for 3 kg of rice today"))
    items += [(6, None), (7, ""), (8, "1 2 3 4 5 6 7 8 9 10 11 12"), (9, "two plus two is four"), (9, "two plus two is four"), (10, " \n")]
    items.append((11, "Tom has 5 red apples in a box. Tom gives 2 apples to Ann. Tom then buys 4 more apples at 3 dollars each. How many apples does Tom have now?"))
    items.append((None, "who wrote it"))
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as h", "2 as words", "3 as form")
    filler = lambda n: prose(rng, vocab, n)
    asked, story = items[5][1], items[12][1]
    other = "maria bought 31 red apples and 9 green pears, then gave 31 apples to Petra for 5 kg of rice today"
    torn = "maria bought 31 red apples and 9 green pears, then gave 40 apples to Petra for 5 kg of rice today"
    mark = story.replace("Tom", "Mark").replace("5", "17").replace("Ann", "Mary Ann")
    docs = [
        (0, filler(80)), (1, filler(30) + " " + items[0][1] + " " + filler(20)), (2, items[1][1]), (2, items[1][1]), (3, None), (4, ""),
        (5, "so " + asked + " end"), (6, "now " + other + " end"), (7, "now " + torn + " end"), (8, "1 2 3 4 5 6 7 8 9 10 11 12 13"),
        (9, "and two plus two is four then"), (None, items[2][1]), (10, " ".join(items[3][1].split(" ")[:9]) + " " + filler(40)),
        (11, filler(300) + " " + mark + " " + filler(5)), (12, story.lower()), (13, "X " + story.upper()), (14, mark.replace("Mark gives", "Jane gives")), (15, "So who wrote it all?"),
        (16, "1 2 3 4 5 6 7 8 9 10 x 12"), (17, story.replace("then buys", "then very soon buys")), (18, (items[0][1] + " ") * 40), (19, filler(6000) + " " + asked), (20, "all the Great " + story + " Then it ends"),
    ]
    found = decontamination.contaminated(spark, make(spark, docs), bench)
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    assert pairs == {(1, 0), (2, 1), (5, 5), (6, 5), (8, 8), (9, 9), (None, 2), (11, 11), (12, 11), (13, 11), (15, None), (16, 8), (17, 11), (18, 0), (19, 5), (20, 11)}
    assert pairs == {(d, i) for d, t in docs for i, x in items if x is not None and _plain_held(t, x)}
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    clash = make(spark, docs).selectExpr("*", "1 as __th", "2 as _th", "3 as _id", "4 as held_id", "5 as c0", "6 as `a.b`", "7 as h")
    left = decontamination.clean(spark, clash, bench)
    assert left.columns == clash.columns
    assert sorted(tuple(r)[0] for r in left.collect()) == [0, 3, 4, 7, 10, 14] and {tuple(r)[5:] for r in left.collect()} == {(1, 2, 3, 4, 5, 6, 7)}
    empty = make(spark, [])
    assert decontamination.contaminated(spark, empty, bench).count() == 0
    assert decontamination.contaminated(spark, make(spark, docs), bench.limit(0)).count() == 0


def test_templates(spark):
    """Words and placeholders against a loop over words."""
    rng = random.Random(31)
    bits = ["Tom", "Mary", "5", "kg", "$3.50", "12%", "3", "dollars", "apples", "Élan", "McX", "a", "(4)", "x9", "Tom,", "9.", "KG", "\n", "  ", "U.S.", "-7", "mm,", "8-9"]
    texts = [(k, " ".join(rng.choices(bits, k=rng.randint(0, 14)))) for k in range(200)]
    from pyspark.sql import functions as F

    t = F.col("text")
    rows = make(spark, texts).select("doc_id", "text", decontamination.template(t).alias("x"), decontamination.plain(t).alias("y"), decontamination.template(F.lower(t), names=False).alias("z")).collect()
    for r in rows:
        assert (r.x, r.y) == _plain_template(r.text), r.text
        assert r.z == _plain_template(r.text.lower(), False)[0], r.text


def test_long_runs(spark):
    """A name of thousands of words and a number of thousands of parts: the patterns take no stack for each of them."""
    item = "Maria bought 12 red apples and 7 green pears, then gave 12 apples to Jonas for 3 kg of rice today"
    name, number = "Abc Éf " * 10_000, ",".join(str(i) for i in range(20_000))
    docs = [(1, name), (2, f"{number} {item}"), (3, f"{name}then {item}"), (4, number)]
    found = decontamination.contaminated(spark, make(spark, docs), spark.createDataFrame([(5, item)], "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(d, 5) for d, t in docs if _plain_held(t, item)} == {(2, 5), (3, 5)}
    from pyspark.sql import functions as F

    for r in make(spark, docs).select("text", decontamination.template(F.col("text")).alias("x"), decontamination.plain(F.col("text")).alias("y")).collect():
        assert (r.x, r.y) == _plain_template(r.text)


def test_long_runs_in_the_pipeline(spark):
    """The pipeline's fourth stage over texts of that kind."""
    import corpus_pipeline

    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("item_id = 0").first().text
    name = "Abc Éf " * 10_000
    left = corpus_pipeline.drop_benchmark(spark, make(spark, [(1, name), (2, f"{name}then {item}"), (3, "plain")]), SF)
    assert {r.doc_id for r in left.collect()} == {1, 3}


# --- 2: SentencePiece ------------------------------------------------------------------------------------------


def _slow_ids(rows, pieces, text):
    """ids of the best path by a dictionary over characters; of equal ones the piece that starts first wins."""
    known = {t.replace("▁", " "): i for i, (t, _, k) in enumerate(rows) if k == 1}
    longest, said = max(map(len, known)), " " + text if text else ""
    best, back = [0] + [None] * len(said), [None] * (len(said) + 1)
    for a in range(len(said)):
        if best[a] is None:
            continue
        for b in range(a + 1, min(len(said), a + longest) + 1):
            i = known.get(said[a:b], len(rows) if b == a + 1 else None)
            if i is not None and (best[b] is None or best[a] + int(pieces.score[i]) > best[b]):
                best[b], back[b] = best[a] + int(pieces.score[i]), (a, i)
    out, end = [], len(said)
    while end:
        a, i = back[end]
        out[:0] = [i] if i < len(rows) else [int(pieces.byte[c]) for c in said[a:end].encode()] if pieces.has_bytes else [pieces.unk]
        end = a
    return out


def test_sentencepiece(spark, corpus, monkeypatch):
    with open(sentencepieces.DEFAULT_MODEL, "rb") as f:
        rows, unigram = sentencepieces.read_model(f.read())
    assert len(rows) == 32000 and not unigram
    p = sentencepieces.Pieces(rows, unigram)
    for i in range(0, 32000, 37):  # the trie finds every piece and nothing else
        if rows[i][2] == 1:
            node = 0
            for c in rows[i][0].replace("▁", " ").encode():
                child = p.base[node] + c
                assert p.check[child] == node
                node = child
            assert p.value[node] == i
    rng = random.Random(3)
    junk = ["$", "%", "&&&", "%%%", "***", "é", "漢", "▁", "\n", " ", "a", "😀"]
    samples = ["Hello world", "the   the", "naïve ▁ x", "漢字 😀!", "a\nb", " ", "", " \n ", "a" * 1500, "é漢" * 600, "ab%%%" * 300]
    samples += [prose(rng, vocabulary(rng), 12) for _ in range(15)] + ["".join(rng.choices(junk, k=rng.randint(1, 40))) for _ in range(300)]
    found = p.encode_all([s.encode() for s in samples])
    for k, s in enumerate(samples):
        own = found.ids[found.first[k] : found.first[k + 1]]
        assert own.tolist() == _slow_ids(rows, p, s) == p.encode(s).tolist(), s
        assert found.by_byte[k] == p.is_byte[own].sum()
    monkeypatch.setattr(sentencepieces, "LONG_UNIT", 2)  # unit by unit
    assert p.encode_all([s.encode() for s in samples]).ids.tolist() == found.ids.tolist()
    monkeypatch.undo()
    small = [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("b", -2.0, 1), ("▁ab", -3.0, 1), ("ab", -1.5, 1), ("▁", -1.5, 1), ("c▁", -0.5, 1)]
    q = sentencepieces.Pieces(small, True)  # log probabilities of its own, no byte pieces, a piece that ends a word
    assert not q.apart and q.encode("abc ab").tolist() == _slow_ids(small, q, "abc ab") == [3, 6, 4]
    assert q.encode("ab").tolist() == [3] and q.encode("a?").tolist() == [1, 0]
    docs = make(spark, corpus).withColumn("IDS", words_col("clash")).withColumn("a.b", words_col("dots")).withColumn("decoded", words_col("x"))
    encoded = sentencepieces.encode(spark, docs)
    assert encoded.columns == ["doc_id", "text", "lang", "source", "n_chars", "a.b", "decoded", "ids", "n_tokens", "n_byte_pieces"]
    out = sentencepieces.decode(spark, encoded).collect()
    assert Counter((r.doc_id, r.text, r.decoded, r.n_tokens) for r in out) == Counter((i, t, t or "", len(p.encode(t or ""))) for i, t in corpus)
    again = sentencepieces.encode(spark, docs, back=True).collect()
    assert Counter((r.doc_id, r.text, tuple(r.ids)) for r in again) == Counter((r.doc_id, r.decoded, tuple(r.ids)) for r in out)
    ids = spark.createDataFrame([([5, None, 99_999, -3],), (None,), ([],), ([p.byte[0xFF].item()],)], "ids array<int>")
    assert [r.decoded for r in sentencepieces.decode(spark, ids).collect()] == [p.decode([5]), "", "", "\ufffd"]
    dig = sentencepieces.digest(spark, docs).collect()
    assert all(r.round_trip for r in dig)
    sha = lambda t: hashlib.sha256(np.array(p.encode(t or ""), "<i4").tobytes()).hexdigest()
    assert Counter((r.doc_id, r.ids_sha256) for r in dig) == Counter((i, sha(t)) for i, t in corpus)
    assert sentencepieces.digest(spark, make(spark, [])).count() == sentencepieces.encode(spark, make(spark, [])).count() == 0


def words_col(name):
    from pyspark.sql import functions as F

    return F.lit(name)


# --- 3: personal data ------------------------------------------------------------------------------------------


def _plain_spans(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or kind == "card" and 14 <= len(digits) <= 19 and pii.luhn(digits) or kind == "phone" and 10 <= len(digits) <= 15
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans():
    rng = random.Random(1)
    alphabet = "ab1 2@.+-()9_%é\n4"
    for _ in range(4000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(t) == _plain_spans(t), t
    fixed = "x a.b@c.d.e@f.g 1.2.3.4.5.6.7.8 999.1.1.1 4111 1111-1111 1111 +1 (555) 123-4567 +12 4111111111111111"
    assert pii.base_spans(fixed) == _plain_spans(fixed)
    assert pii.base_spans("1" * 20_000 + "@" * 1000) == _plain_spans("1" * 20_000 + "@" * 1000)


def test_field_decodes_the_best_path():
    field = pii.train(pii.labelled_rows(80), rounds=20)
    rng = np.random.default_rng(0)
    k = len(pii.TAGS)
    for _ in range(5):
        e = rng.normal(size=(1, 4, k)).astype(np.float32)
        best = max(itertools.product(range(k), repeat=4), key=lambda p: field.start[p[0]] + sum(e[0, t, p[t]] for t in range(4)) + sum(field.moves[p[t], p[t + 1]] for t in range(3)))
        assert tuple(field.decode(e)[0].tolist()) == best


def test_find_pii(spark, corpus):
    field = pii.train()
    tagger = pii.Tagger(field)
    found = tagger.spans(["Call (456) 555-2186 or 555-123-4567.", "write bob (at) example (dot) com", "id 123-45-6789, ok", "The 12 dots at 4.0 of 2024-05-17 ###", ""])
    assert [[x[2] for x in f] for f in found] == [["phone", "phone"], ["email"], ["id"], [], []]
    held = pii.labelled_rows(200, seed=99)
    hit = wrong = total = 0
    for tokens, tags in held:
        text = " ".join(tokens)
        spans = tagger.spans([text])[0]
        at = 0
        for w, tag in zip(tokens, tags, strict=True):
            got = next((s[2] for s in spans if s[0] < at + len(w) and s[1] > at), "O")
            base = any(s[0] < at + len(w) and s[1] > at for s in pii.base_spans(text))
            if tag in ("phone", "id") and not base:
                total, hit = total + 1, hit + (got == tag)
            wrong += tag == "O" and got != "O" and not base
            at += len(w) + 1
    assert hit / total > 0.9 and wrong / sum(len(r[0]) for r in held) < 0.01
    docs = [*corpus, (500, "mail a.b@c.org now, 10.0.0.1 or (456) 555-2186"), (501, "é漢 x@y.z")]
    rows = pii.digest(pii.find_pii(spark, make(spark, docs))).collect()
    assert len(rows) == len(docs)
    by_id = {r.doc_id: r for r in rows}
    for i, t in docs:
        r, spans = by_id[i], _plain_spans(t or "")
        if i not in (None, 7):
            assert r.base_sha256 == pii.sha(",".join(f"{k}:{s}:{e}" for s, e, k in spans))
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[2] == k for x in spans) for k in pii.KINDS]
            assert {f"{k}:{s}:{e}" for s, e, k in spans} <= set(r.spans.split(","))
    assert by_id[500].spans == "email:5:14,ip:20:28,phone:32:46"
    assert pii.find_pii(spark, make(spark, [])).count() == 0


# --- 4: toxicity -----------------------------------------------------------------------------------------------


def test_network_gradients():
    rng = np.random.default_rng(2)
    net = toxicity.Network()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, index, y = rng.normal(size=(7, toxicity.INPUTS)), rng.integers(0, 7, (3, 5)), np.array([0.0, 1.0, 1.0])

    def loss():
        z = net.forward(x, index).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y)))

    grads = net.grads(x.astype(np.float64), index, y)
    for k, g in grads.items():
        flat = net.w[k].ravel()
        for i in rng.integers(0, flat.size, 3):
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-2 - g.ravel()[i]) < 2e-3, k


def test_network_forward():
    """Window by window and step by step, in plain Python."""
    rng = np.random.default_rng(6)
    net = toxicity.Network(9)
    x, index = rng.normal(size=(6, toxicity.INPUTS)).astype(np.float32), rng.integers(0, 6, (4, 7))
    w, h = net.w, toxicity.HIDDEN
    gate = lambda v: 1 / (1 + math.exp(-v))
    for row, got in zip(index, net.forward(x, index), strict=True):
        states = {}
        for d in "fb":
            s = [0.0] * h
            for t in range(7) if d == "f" else range(6, -1, -1):
                p = [sum(x[row[t], i] * w[f"x{d}"][i, k] for i in range(toxicity.INPUTS)) + w[f"b{d}"][k] for k in range(3 * h)]
                zr = [gate(p[k] + sum(s[i] * w[f"u{d}"][i, k] for i in range(h))) for k in range(2 * h)]
                new = [math.tanh(p[2 * h + k] + sum(zr[h + i] * s[i] * w[f"c{d}"][i, k] for i in range(h))) for k in range(h)]
                s = [s[k] + zr[k] * (new[k] - s[k]) for k in range(h)]
                states[d, t] = s
        both = [states["f", t] + states["b", t] for t in range(7)]
        e = [sum(math.tanh(sum(v[i] * w["a"][i, k] for i in range(2 * h))) * w["v"][k] for k in range(toxicity.ATTEND)) for v in both]
        a = [math.exp(v) / sum(map(math.exp, e)) for v in e]
        logit = sum(a[t] * both[t][i] * w["o"][i] for t in range(7) for i in range(2 * h)) + w["k"][0]
        assert abs(logit - got) < 1e-4


def test_windows_cover_all_words():
    for n in (0, 1, 16, 31, 32, 33, 48, 49, 100, 1000):
        inputs = toxicity.Inputs([b"x", " ".join(f"w{k}" for k in range(n)).encode(), b"y z"])
        doc, win = inputs.windows()
        own = win[doc == 1]
        seen = {int(c) for c in own.ravel() if c < len(inputs)}
        assert len(seen) == n and len(own) == max(1, -(-(n - 16) // 16))


def test_sample_is_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_BYTES", 1000)
    docs = make(spark, [(k, "x" * (600 if k % 3 == 0 else 90)) for k in range(90)] + [(4, "y")])
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(90)], "doc_id bigint, quality int, toxic int")
    rows = toxicity.sample(docs, labels)
    assert all(900 < sum(len(t) for t, y in rows if y == k) <= 1000 for k in (0, 1))
    assert all(set(t) == {"x"} for t, _ in rows)


def test_toxicity(spark):
    rng = random.Random(4)
    vocab = vocabulary(rng)
    bad = ["zlkrud", "zlkrun", "zlkrip", "qovvex"]
    rows, labels = [], []
    for i in range(500):
        w = prose(rng, vocab, rng.randint(20, 150)).split(" ")
        toxic = int(i % 5 == 0)
        for _ in range(4 * toxic):
            w[rng.randrange(len(w))] = rng.choice(bad) + rng.choice(["", ",", "!"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    rows += [(600, None), (601, ""), (602, " ".join(vocab * 20)), (603, " ".join(vocab * 20) + " zlkrud qovvex, Zlkrip."), (None, "x")]
    lab = spark.createDataFrame([*labels, (None, 1, 1), (700, 0, None)], "doc_id bigint, quality int, toxic int")
    docs = make(spark, rows).selectExpr("*", "1 as score", "0 as held_out")
    got = {r.doc_id: r for r in toxicity.scored(spark, docs, lab).collect()}
    assert len(got) == len(rows)
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in set(held)) for i in range(500))
    assert np.mean([got[i].predicted == int(i % 5 == 0) for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert [got[i].predicted for i in (600, 601, 602, 603)] == [0, 0, 0, 1]
    none = toxicity.scored(spark, docs, lab.limit(0)).collect()
    assert all(r.score == 0.0 for r in none)
    assert toxicity.scored(spark, make(spark, []), lab).count() == 0


# --- 5: suffix tree --------------------------------------------------------------------------------------------


def _tokens(t):
    return WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


class _PlainTree:
    """The tree by dictionaries over tuples of symbols."""

    def __init__(self, texts, head, least, often, gain, strength, alpha=0.1):
        count = Counter(w for t in texts for w in _tokens(t))
        self.count, self.alpha, self.strength, self.ends = count, alpha, strength, len(texts)
        floor = next((n for n in sorted(set(count.values())) if sum(c >= n for c in count.values()) <= head), 1 << 60)
        self.own = {w for w, c in count.items() if c >= max(floor, least)}
        self.symbols = {w: w if w in self.own else int(c) for w, c in zip(count, suffix_tree.Tokens([" ".join(count).encode()]).of_class, strict=False)}
        self.total = sum(count.values()) + self.ends
        lines = [["<s>", *[self.symbol(w) for w in _tokens(t)], "</s>"] for t in texts]
        mass = Counter(s for line in lines for s in line[1:])
        size = len(self.own) + suffix_tree.CLASSES + 1
        self.root = lambda s: (mass[s] + alpha) / (self.total + alpha * size)
        self.shared = Counter()
        for w, c in count.items():
            if w not in self.own:
                self.shared[self.symbol(w)] += c + alpha
        self.states = {}
        times = Counter(s for line in lines for s in line[:-1])
        k, tried = 1, {(s,) for s, n in times.items() if n >= least}
        while tried:
            after = defaultdict(Counter)
            for line in lines:
                for at in range(max(1, k), len(line)):
                    if (c := tuple(line[at - k : at])) in tried:
                        after[c][line[at]] += 1
            kept = {}
            for c, n in after.items():
                times = sum(n.values())
                spare = strength + sum(x for x in n.values() if x < often)
                won = 0.0
                for s, x in n.items():
                    p = self.symbol_p(c[1:], s)
                    less = (x - 1 if x > often else 0) + (spare - 1 if x < often else spare + often - 1 if x == often else spare) * p
                    won += x * math.log(less / (times - 1 + strength) / p)
                if times >= least and won > gain:
                    kept[c] = ({s: x for s, x in n.items() if x >= often}, times, spare)
            tried = {(*c, s) for c, n in after.items() for s, x in n.items() if x >= least and s != "</s>" and (*c[1:], s) in kept}
            self.states |= kept
            self.depth, k = k, k + 1

    def symbol(self, w):
        if w not in self.symbols:
            self.symbols[w] = int(suffix_tree.Tokens([w.encode()]).of_class[0])
        return self.symbols[w]

    def symbol_p(self, c, s):
        """Of the longest state that c ends with."""
        while c and c not in self.states:
            c = c[1:]
        if not c:
            return self.root(s)
        n, times, spare = self.states[c]
        return (n.get(s, 0) + spare * self.symbol_p(c[1:], s)) / (times + self.strength)

    def score(self, text):
        before, out = ("<s>",), 0.0
        for w in [*_tokens(text), None]:
            s = "</s>" if w is None else self.symbol(w)
            p = self.symbol_p(before, s)
            if isinstance(s, int):
                p *= (self.count[w] + self.alpha) / (self.shared[s] + self.alpha)
            out, before = out + math.log10(p), (*before, s)[-self.depth :]
        return out


@pytest.mark.parametrize(("head", "known", "followers"), [(1 << 20, 1 << 20, 1 << 20), (60, 1 << 20, 40), (150, 12, 0)])
def test_suffix_tree(spark, corpus, head, known, followers):
    """Against dictionaries; the same whether words, states and followers are held or joined."""
    rng = random.Random(11)
    rows = list(corpus)
    chain = "the red fox saw the red dog and the old fox ran".split(" ")
    for k in range(60):
        w = [x for _ in range(12) for x in (chain if rng.random() < 0.7 else rng.sample(chain, 5))]
        rows.append((1000 + k, " ".join(w)))
    _suffix_tree_is_plain(spark, rows, {"least": 12, "often": 2, "gain": 6.0, "strength": 5.0}, {1, 2, 3}, head, known, followers)


def test_suffix_tree_production(spark):
    """The constants of the query, over the whole smallest table."""
    own = {"least": suffix_tree.LEAST, "often": suffix_tree.OFTEN, "gain": suffix_tree.GAIN, "strength": suffix_tree.STRENGTH}
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    _suffix_tree_is_plain(spark, rows, own, {1, 2})


def _suffix_tree_is_plain(spark, rows, own, lengths, head=suffix_tree.HEAD, known=suffix_tree.HEAD_CONTEXTS, followers=suffix_tree.HEAD_GRAMS):
    docs = make(spark, rows).selectExpr("*", "1 as h", "2 as uid")
    out = suffix_tree.score(spark, docs, head, known, followers, **own).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    tree = _PlainTree([t for i, t in rows if not held(i)], head, **own)
    assert {len(c) for c in tree.states} >= lengths
    n, v = tree.total, len(tree.count) + 1
    count = tree.count | {None: tree.ends}
    expected = Counter()
    for i, t in rows:
        w = [*_tokens(t), None]
        base = sum(math.log10((count.get(x, 0) + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        expected[(i, held(i), len(w), sum(x in count for x in w), n, round(base, 6), round(tree.score(t), 5))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 5)) for r in out) == expected


def test_suffix_tree_parts(spark, corpus, monkeypatch):
    """Counts and lookups in many parts; texts that ask for followers are blocks, not a row for each token that asks."""
    monkeypatch.setattr(suffix_tree, "PART_TOKENS", 500)
    monkeypatch.setattr(suffix_tree, "PART_GRAMS", 8)
    made, plain = [], suffix_tree.symbol_scores
    monkeypatch.setattr(suffix_tree, "symbol_scores", lambda *x: made.append(plain(*x)) or made[0])
    rng = random.Random(12)
    words_ = [f"word{k}" for k in range(40)]
    rows = [*corpus, *[(1000 + k, " ".join(words_[min(int(rng.expovariate(0.15)), 39)] for _ in range(200))) for k in range(40)]]
    _suffix_tree_is_plain(spark, rows, {"least": 12, "often": 2, "gain": 6.0, "strength": 5.0}, {1}, 60, 1 << 20, 10)
    n = made[0].count()
    assert len(rows) < n < len(rows) + 40 * 200 // 3


def test_suffix_tree_turns(spark, corpus, monkeypatch):
    """More contexts than workers hold: turns by last symbol, and still no row for each token that asks."""
    made, plain = [], suffix_tree.symbol_scores

    def counted(*x):
        out = plain(*x)
        made.append(out.count())
        return out

    monkeypatch.setattr(suffix_tree, "symbol_scores", counted)
    rng = random.Random(13)
    words_ = [f"word{k}" for k in range(40)]
    rows = [*corpus, *[(1000 + k, " ".join(words_[min(int(rng.expovariate(0.15)), 39)] for _ in range(200))) for k in range(40)]]
    _suffix_tree_is_plain(spark, rows, {"least": 12, "often": 2, "gain": 6.0, "strength": 5.0}, {1}, 60, 20, 5)
    assert len(made) > 1 and max(made) < len(rows) + 40 * 200 // 3


def test_suffix_tree_disk(spark, corpus, monkeypatch):
    """What is on disk when the steps are done: no shuffle files, and of the tables only those that the result reads."""

    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}

    made, plain = [], suffix_tree.Shelf.put
    monkeypatch.setattr(suffix_tree.Shelf, "put", lambda self, df, name: made.append((name, plain(self, df, name))) or made[-1][1])
    before, settings = shuffles(), dict(spark.conf.getAll)
    out = suffix_tree.score(spark, make(spark, corpus), 60, 1 << 20, 10, least=12, gain=6.0)
    until = time.time() + 20
    while shuffles() - before and time.time() < until:  # files are deleted in the background
        time.sleep(0.2)
    assert not shuffles() - before
    assert {n for n, t in made if os.path.exists(t._shelf_path.removeprefix("file://"))} == {"words", "symbols", "more", "tried"}
    assert {k: v for k, v in spark.conf.getAll.items() if "maxBytesPerBatch" not in k} == {k: v for k, v in settings.items() if "maxBytesPerBatch" not in k}
    assert out.count() == len(corpus) == len(out.collect())


def test_suffix_tree_small_numbers():
    """Symbols are numbered by falling counts."""
    n = np.array([70, 900, 3, 70, 500])
    v = suffix_tree.Vocabulary(0, np.arange(5, dtype=np.uint64), n, 9, {}, np.zeros(5, np.int64), 64, 0.1)
    assert v.symbol.tolist() == [2, 0, -1, 3, 1] and v.times[: v.size].tolist() == [900, 500, 70, 70]
    assert np.allclose(v.root[:4] * (v.total + 0.1 * v.symbols) - 0.1, [900, 500, 70, 70])


def test_suffix_tree_bloom(spark):
    """Every key is found, hardly any other, and keys leave the tasks as few rows of about three bytes a key."""
    rng = np.random.default_rng(3)
    c, following = rng.integers(-(1 << 63), 1 << 63, 40_000), rng.integers(0, 5000, 40_000)
    grams = spark.createDataFrame([(int(a), int(b)) for a, b in zip(c, following, strict=True)], "c bigint, next int").coalesce(1)
    bloom = suffix_tree.Bloom(grams)
    assert bloom.may_have(suffix_tree.gram_key(c.view(np.uint64), following)).all()
    assert bloom.may_have(suffix_tree.gram_key(c.view(np.uint64), following + 5000)).mean() < 0.001
    keys = suffix_tree.gram_key(c.view(np.uint64), following) >> np.uint64(24)
    assert len(suffix_tree.rising(np.sort(keys).astype(np.int64))) < 5 * len(keys)


def test_suffix_tree_edges(spark, corpus):
    out = suffix_tree.score(spark, make(spark, corpus)).collect()
    assert len(out) == len(corpus) and all(r.score <= 0 and math.isfinite(r.score) for r in out)
    assert suffix_tree.score(spark, make(spark, [])).count() == 0
    lone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    only = suffix_tree.score(spark, make(spark, [(lone, "a b"), (lone, None)])).collect()  # no training text
    assert {(r.train_tokens, r.n_known, r.held_out) for r in only} == {(0, 0, True)} and all(math.isfinite(r.score) for r in only)


# --- 6: line dedup ---------------------------------------------------------------------------------------------


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_banded_distance():
    rng = random.Random(6)
    for _ in range(6000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 12)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "b", "c"])
        b = "".join(b)
        for edits in (1, 2, 3):
            assert line_dedup.within(a, b, edits) == (_distance(a, b) <= edits), (a, b, edits)


def _plain_lines(rows):
    """Kept lines by brute force: classes over all pairs of distinct lines."""
    occ = [(i, k, s) for i, t in dict.fromkeys(rows) for k, s in line_dedup.lines_of(t)]
    distinct = list(dict.fromkeys(o[2] for o in occ))
    root = {x: x for x in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(distinct, 2):
        most = (min(len(a), len(b)) >= 20) + (min(len(a), len(b)) >= 40)
        if most and abs(len(a) - len(b)) <= most and find(a) != find(b) and _distance(a, b) <= most:
            root[find(a)] = find(b)
    first = {}
    for i, k, s in sorted(occ, key=lambda o: ((o[0] is not None, o[0]), o[1])):
        first.setdefault(find(s), (i, k))
    gone = defaultdict(set)
    for i, k, s in occ:
        if first[find(s)] != (i, k):
            gone[i].add((k, s))
    out = Counter()
    for i, t in rows:
        drop = {k for k, s in gone[i] if (k, s) in line_dedup.lines_of(t)}
        text = t if not drop else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop)
        out[(i, len(line_dedup.lines_of(t)), len(drop), text)] += 1
    return out


def test_line_dedup(spark):
    rng = random.Random(8)
    vocab = vocabulary(rng, 60)
    line = lambda: " ".join(rng.choice(vocab) for _ in range(rng.randint(7, 12)))
    pool = [line() for _ in range(25)]

    def vary(s):
        s = list(s)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(s))
            s[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "é", "yy"])
        return "".join(s)

    rows = [(i, "\n".join(vary(rng.choice(pool)) if rng.random() < 0.6 else line() for _ in range(rng.randint(1, 6)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "short\nshort\nshort"), (73, "\n\n" + pool[0] + "  \r\n" + pool[0]), (None, pool[1] + "\n" + line()), (74, " " + pool[0]), (75, "漢" * 50 + "\n" + "漢" * 49 + "字")]
    rows += [rows[3], rows[3]]
    docs = make(spark, rows).selectExpr("*", "1 as N_lines", "2 as h", "3 as th", "4 as gone", "5 as _id", "6 as _th", "7 as `a.b`")
    got = line_dedup.deduplicated(spark, docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "h", "th", "gone", "_id", "_th", "a.b", "n_lines", "n_removed"]
    assert {tuple(r)[5:11] for r in got.collect()} == {(2, 3, 4, 5, 6, 7)}
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got.collect()) == _plain_lines(rows)
    assert line_dedup.deduplicated(spark, make(spark, [])).count() == 0


def test_short_lines(spark):
    """Lines of all lengths from one character: equal ones go, and from 20 characters on those within one edit, from 40 on two."""
    rng = random.Random(18)
    bases = ["".join(rng.choice("abcdefgh XYZ") for _ in range(n)).strip(" ") or "z" for n in (1, 1, 2, 3, 4, 7, 14, 18, 19, 20, 21, 22, 30, 38, 39, 40, 41, 42, 60)]

    def line():
        s = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 2, 3))):
            k = rng.randrange(len(s) + 1)
            s[k : k + rng.randint(0, 1)] = rng.choice(["", "q", "r"])
        return "".join(s).strip(" ") or "z"

    rows = [(i, "\n".join(line() for _ in range(rng.randint(1, 4)))) for i in range(50)]
    rows += [(60 + i, f"Step {i}\n{2020 + i}\nno!\ndog\n{i}0%") for i in range(5)]
    rows += [(i, f"All rights reserved.\n\n{'abc' * i}\nReleased under the MIT License{'.' * (i % 3)}") for i in range(50, 60)]
    said = [(i, k, s) for i, t in rows for k, x in enumerate(t.split("\n")) if (s := x.strip(" "))]
    group = {s: {s} for _, _, s in said}
    for a, b in itertools.combinations(group, 2):
        most = (min(len(a), len(b)) >= 20) + (min(len(a), len(b)) >= 40)
        if group[a] is not group[b] and _distance(a, b) <= most:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    seen, gone = set(), set()
    for i, k, s in sorted(said):
        if id(group[s]) in seen:
            gone.add((i, k))
        seen.add(id(group[s]))
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}
    got = line_dedup.deduplicated(spark, make(spark, rows)).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert sum(r.n_removed for r in got) == len(gone) > 20 and sum(r.n_lines for r in got) == len(said)
    assert want[51] == "\n" + "abc" * 51
    left = [x for t in want.values() for x in t.split("\n")]
    assert {f"Step {i}" for i in range(5)} | {str(2020 + i) for i in range(5)} | {"no!", "dog"} <= set(left) and left.count("dog") == 1


# --- 7: resampling ---------------------------------------------------------------------------------------------


def test_resampling(spark):
    rng = random.Random(2)
    vocab = vocabulary(rng)
    rows = [(i, prose(rng, vocab, rng.randint(30, 200)) if i % 4 else " ".join(w.upper() + "!!" for w in rng.choices(vocab, k=80))) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "x y z")]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 300, 2)] + [(None, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = resampling.resample(spark, make(spark, rows).selectExpr("*", "1 as key", "2 as place"), labels, share=0.7).collect()
    assert len(got) == len(rows)
    k = math.ceil(0.7 * len(rows))
    keys = sorted((r.key for r in got), reverse=True)
    assert sum(r.kept for r in got) == k and all(r.kept == (r.key >= keys[k - 1]) for r in got)
    assert np.mean([r.kept for r in got if r.doc_id and r.doc_id < 300 and r.doc_id % 4]) > 0.9
    assert np.mean([r.kept for r in got if r.doc_id is not None and r.doc_id < 300 and r.doc_id % 4 == 0]) < 0.2
    # both models by counting n-grams, the weights by adding up
    grams = {i: resampling.ngrams([(t or "").encode()])[1].tolist() for i, t in rows}
    raw, target = (Counter(b for i, _ in rows for b in grams[i] if ok(i)) for ok in (lambda i: True, lambda i: i is not None and i < 300 and i % 4 and i % 2 == 0))
    b = resampling.BUCKETS
    p = lambda c, x: (c[x] + 1) / (sum(c.values()) + b)
    ratio = {x: math.log(p(target, x) / p(raw, x)) for x in raw}
    words = lambda t: WORD.findall((t or ""))
    for r in got:
        total = sum(ratio[x] for x in grams[r.doc_id])
        assert math.isclose(r.log_ratio, total, abs_tol=1e-9) and math.isclose(r.log_weight, total / max(1, len(grams[r.doc_id])) * 200, abs_tol=1e-9)
        assert len(grams[r.doc_id]) == max(0, 2 * len(words(dict(rows)[r.doc_id])) - 1)
    plain = resampling.resample(spark, make(spark, rows), labels, share=0.7, scale=None).collect()
    assert all(r.log_weight == r.log_ratio for r in plain) and sum(r.kept for r in plain) == k
    doc, bucket = resampling.ngrams([b"a b a", b""])
    assert doc.tolist() == [0] * 5 and len(set(bucket.tolist())) == 4
    tied = resampling.resample(spark, make(spark, [(1, "a")] * 5 + [(2, None)]), labels.limit(0), share=0.5).collect()
    assert len(tied) == 6 and {r.kept for r in tied if r.doc_id == 1} in ({True}, {False})
    assert resampling.resample(spark, make(spark, []), labels).count() == 0


# --- 8: suffix runs --------------------------------------------------------------------------------------------


def _plain_removed(texts, n=200):
    seen = Counter()
    for t in texts:
        seen.update(t[k : k + n] for k in range(len(t) - n + 1))
    out = []
    for t in texts:
        hit = bytearray(len(t))
        for k in range(len(t) - n + 1):
            if seen[t[k : k + n]] > 1:
                hit[k : k + n] = b"\1" * n
        kept = bytes(c for c, h in zip(t, hit, strict=True) if not h)
        out.append((len(t), sum(hit), len(re.findall(b"\1+", bytes(hit))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("group", "hot", "part"), [(2000, 20_000, 4_000_000), (1, 1, 1000), (5, 0, 333)])
def test_suffix_runs(spark, corpus, group, hot, part, monkeypatch):
    monkeypatch.setattr(suffix_runs, "GROUP", group)
    monkeypatch.setattr(suffix_runs, "PART_BYTES", part)
    if hot < 20_000:  # every key by a join, or by the broadcast of the frequent ones
        monkeypatch.setattr(suffix_runs, "HOT", hot)
        monkeypatch.setattr(suffix_runs, "small_enough", lambda df, most: df.count() < 3 or "times" not in df.columns)
    rng = random.Random(77)
    vocab = vocabulary(rng)
    passage = prose(rng, vocab, 60)
    rows = [*corpus, *[(3000 + k, prose(rng, vocab, k) + passage + prose(rng, vocab, 30)) for k in range(25)]]
    expected = Counter((i, *r) for (i, _), r in zip(rows, _plain_removed([(t or "").encode() for _, t in rows]), strict=True))
    got = suffix_runs.removed(spark, make(spark, rows).selectExpr("*", "1 as a", "2 as uid", "3 as k")).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == expected
    if group == 1:
        assert suffix_runs.removed(spark, make(spark, [])).count() == 0


def test_anchors_of_long_texts(monkeypatch):
    """Part by part, each window is in one fragment, and equal windows have equal anchors."""
    rng = random.Random(4)
    text = "".join(rng.choice("ab ") for _ in range(2500)).encode() + b"x" * 700
    text += text[300:1400]
    whole = suffix_runs.anchors_of([text])
    monkeypatch.setattr(suffix_runs, "PART_BYTES", 431)
    split = suffix_runs.anchors_of([text])
    assert len(split[0]) > len(whole[0])
    for _, h, _, start, end, place in (whole, split):
        of_window = {}
        for a, s, e, p in zip(h.tolist(), start.tolist(), end.tolist(), place.tolist(), strict=True):
            for w in range(s, e - suffix_runs.LENGTH + 1):
                assert w not in of_window and w <= s + p <= w + suffix_runs.LENGTH - suffix_runs.GRAM
                of_window[w] = (a, text[s + p : s + p + suffix_runs.GRAM])
        assert sorted(of_window) == list(range(len(text) - suffix_runs.LENGTH + 1))
        by_text = defaultdict(set)
        for w, a in of_window.items():
            by_text[text[w : w + suffix_runs.LENGTH]].add(a)
        assert all(len(x) == 1 for x in by_text.values())


def test_run_index():
    rng = random.Random(3)
    parts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 60))) for _ in range(12)]
    parts += [parts[0][:30], b"ab" * 20, b"a" * 50, parts[1]]
    index = suffix_runs.RunIndex(parts)
    stats = index.statistics()
    at = [(k, i) for k, p in enumerate(parts) for i in range(len(p))]
    for k, i in at:
        longest = 0
        for m, j in at:
            if (m, j) != (k, i):
                n = 0
                while i + n < len(parts[k]) and j + n < len(parts[m]) and parts[k][i + n] == parts[m][j + n]:
                    n += 1
                longest = max(longest, n)
        assert stats[index.first[k] + i] == longest
    assert index.runs < index.n


# --- 9: host rules ---------------------------------------------------------------------------------------------


def test_measure(corpus):
    for _, t in corpus:
        t = t or ""
        w = WORD.findall(t)
        tri = Counter(zip(w, w[1:], w[2:], strict=False))
        rep = {k + j for k in range(len(w) - 2) if tri[(w[k], w[k + 1], w[k + 2])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        got = host_rules.measure(t.encode())
        assert got == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(rep))


def test_host_rules(spark):
    rng = random.Random(1)
    vocab = vocabulary(rng)
    good = lambda: prose(rng, vocab, 90)
    rows = [(i, good(), "en", "fine", 1) for i in range(60)] + [(100 + i, "too short", "en", "bad", 1) for i in range(60)] + [(200 + i, good(), "en", "bad", 1) for i in range(3)]
    rows += [(300, good(), "en", None, 1), (301, None, "en", "fine", 1), (302, "", "en", "once", 1), (None, good(), "en", "fine", 1), (303, good() + " " + " ".join(f"#{k}##" for k in range(60)), "en", None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as host", "2 as kept", "3 as n")
    got = {r.doc_id: r for r in host_rules.host_rules(spark, docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in range(60)) and got[300].kept and got[None].kept
    assert not any(got[200 + i].kept or got[200 + i].base_failed for i in range(3))
    assert not got[303].base_failed and not got[303].kept  # without a host, all of its own rules
    assert got[301].base_failed and got[302].base_failed and not got[301].kept
    # a single failure shrinks towards all hosts
    assert got[302].rate < 1
    assert host_rules.host_rules(spark, make(spark, [])).count() == 0


# --- 10: Jaccard join ------------------------------------------------------------------------------------------


def _plain_components(rows, k=3):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)].append(i)
    return Counter((i, len(sets[k]), (min(ids[find(k)]) if ids[find(k)] else None) if sets[k] else i) for k, (i, _) in enumerate(rows))


def test_jaccard_join(spark, corpus):
    docs = make(spark, corpus).selectExpr("*", "1 as id", "2 as n")
    got = jaccard_join.classes_of(spark, docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _plain_components(corpus)
    assert jaccard_join.classes_of(spark, make(spark, [])).count() == 0


def test_jaccard_join_of_near_copies(spark):
    rng = random.Random(12)
    vocab = vocabulary(rng)
    rows = []
    for n in (9, 10, 11, 16, 17, 18, 19, 20, 21, 22, 40, 150, 400):
        base = [rng.choice(vocab) for _ in range(n + 2)]
        for k in range(14):
            w = list(base)
            for _ in range(rng.randint(0, 1 + n // 60)):
                j = rng.randrange(len(w))
                w[j : j + rng.randint(0, 1)] = [rng.choice(vocab)] if rng.random() < 0.6 else []
            if k % 3 == 0:
                w = w[: len(w) - k % 2 - 1]
            rows.append((len(rows), " ".join(w)))
    got = jaccard_join.classes_of(spark, make(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _plain_components(rows)
    kept = jaccard_join.keep_one(spark, make(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted({r.component_id for r in got})


def test_keep_one_of_repeated_rows(spark):
    rng = random.Random(14)
    vocab = vocabulary(rng)
    a, b, c = (prose(rng, vocab, 60) for _ in range(3))
    near = a.rsplit(" ", 1)[0]
    rows = [(5, a), (5, a), (5, near), (9, a), (None, a), (None, b), (None, b), (3, c), (4, ""), (4, ""), (None, None), (6, None), (3, c)]
    docs = make(spark, rows).selectExpr("*", "1 as th", "2 as c0", "3 as times", "4 as `x.y`", "5 as root", "6 as TEXT_")
    kept = jaccard_join.keep_one(spark, docs)
    assert kept.columns == docs.columns
    out = Counter((r[0], r[1]) for r in map(tuple, kept.collect()))
    one = {x: n for x, n in out.items() if x[0] == 5}
    assert sum(one.values()) == 1 and {x: n for x, n in out.items() if x[0] != 5} == {(None, b): 1, (3, c): 1, (4, ""): 2, (None, None): 1, (6, None): 1}
    assert {tuple(r)[5:] for r in kept.collect()} == {(1, 2, 3, 4, 5, 6)}


def test_jaccard_join_of_five_words(spark):
    """Sets of 5-word runs that are equal to 80 % of their union, of all sizes around the light ones; the pipeline's stage."""
    import corpus_pipeline

    assert jaccard_join.light_sizes(90) == (9, 18) and jaccard_join.light_sizes(80) == (4, 8)
    rng = random.Random(13)
    vocab = vocabulary(rng)
    rows = []
    for n in (3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 20, 60, 150):
        base = [rng.choice(vocab) for _ in range(n + 4)]
        for k in range(14):
            w = list(base)
            for _ in range(rng.randint(0, 1 + n // 40)):
                j = rng.choice((0, 1, len(w) - 2, len(w) - 1, rng.randrange(len(w))))
                w[j : j + rng.randint(0, 1)] = [rng.choice(vocab)] if rng.random() < 0.6 else []
            if k % 3 == 0:
                w = w[: len(w) - k % 2 - 1]
            rows.append((len(rows), " ".join(w)))
    runs = lambda t: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := t.lower().split(" ")) else set()
    sets = [runs(t) for _, t in rows]
    root = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = [low if x == high else x for x in root]
    got = jaccard_join.classes_of(spark, make(spark, rows), 5, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), root[i]) for i, _ in rows}
    kept = corpus_pipeline.keep_one(spark, make(spark, rows), SF).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(root))
    assert len(kept) < jaccard_join.keep_one(spark, make(spark, rows)).count()


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1080)] + [(5, 5)]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(Shelf(spark, "test"), spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for p in links if p[0] != p[1] for x in p}
    assert components(Shelf(spark, "test"), spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- edges, the same for all ---------------------------------------------------------------------------------------

_CLASHES = "th h k n c uid a f g s e p ids score key place host gone root id node class symbol c0 c1 doc_id_ __score decoded n_lines n_removed kept n_tokens".split()


def _operators():
    import corpus_pipeline

    lab, bench = "doc_id bigint, quality int, toxic int", "item_id bigint, text string"
    some = lambda s, kind: s.createDataFrame([(1, 1, 0), (2, 0, 1)] if kind == lab else [(1, "a benchmark item of ten words that no text holds")], kind)
    out = {
        "op1": lambda s, d: decontamination.contaminated(s, d, some(s, bench)), "op2": sentencepieces.digest, "op3": lambda s, d: pii.digest(pii.find_pii(s, d)),
        "op4": lambda s, d: toxicity.scored(s, d, some(s, lab)), "op5": suffix_tree.score, "op6": lambda s, d: line_dedup.digest(line_dedup.deduplicated(s, d)),
        "op7": lambda s, d: resampling.resample(s, d, some(s, lab)), "op8": suffix_runs.removed, "op9": host_rules.host_rules, "op10": jaccard_join.classes_of,
    }
    stages = {f"stage {name}": lambda s, d, f=f: f(s, d, SF) for name, f in corpus_pipeline.STAGES}
    return out | stages


@pytest.mark.parametrize("name", [f"op{k}" for k in range(1, 11)] + ["stage toxicity", "stage line_dedup", "stage jaccard_join", "stage decontamination", "stage sentencepiece"])
def test_edges(spark, name):
    """An empty table, nulls in every column, columns with clashing names, rows that repeat and very long texts."""
    run = _operators()[name]
    rng = random.Random(3)
    vocab = vocabulary(rng)
    long = " ".join(rng.choices(vocab, k=8_000)) + " " + "x" * 40_000
    rows = [(1, prose(rng, vocab, 40)), (2, prose(rng, vocab, 40)), *[(3, "one and the same row that repeats many times over and over")] * 9, (None, None), (None, "a b"), (4, None), (5, ""), (6, long), (6, long)]
    docs = make(spark, rows).coalesce(2).selectExpr("doc_id", "text", "cast(null as string) as lang", "if(doc_id > 1, source, null) as source", "n_chars", *[f"{k} as `{c}`" for k, c in enumerate(_CLASHES)], "99 as `a.b`")
    out = run(spark, docs)
    names, got = out.columns, out.collect()
    assert len(set(n.lower() for n in names)) == len(names)
    if name.startswith("stage"):
        kept = [c for c in docs.columns if c in names]
        assert set(docs.columns) - set(kept) <= {"ids", "n_tokens", "n_byte_pieces"}
        for k, c in enumerate(_CLASHES):
            if c in names and not (name == "stage sentencepiece" and c in ("ids", "n_tokens")):
                assert {r[names.index(c)] for r in got} <= {k}
        texts = Counter(r[names.index("text")] for r in got)
        if name == "stage jaccard_join":
            assert texts[rows[2][1]] == 1 and texts[long] == 1
        assert {r[0] for r in got} >= {1, 2, 3, 5, 6}
    elif name != "op1":
        assert len(got) == len(rows)
    assert run(spark, docs.limit(0)).isEmpty()


# --- SQL and the pipeline ------------------------------------------------------------------------------------------

SF = "/root/testdata/sf0.001"


def test_host_rules_match_sql(spark):
    import duckdb

    from promolake.llm.queries import oracle_sql, queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    for name, sql in oracle_sql().items():
        df = queries()[name](spark, SF)
        want = con.execute(sql)
        names = [d[0] for d in want.description]
        assert names == df.columns
        assert Counter(map(tuple, df.collect())) == Counter(want.fetchall())


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, rows = docs.columns, docs.count()
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    shelf = Shelf(spark, "test")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = shelf.put(stage(spark, docs, SF), name)
        assert after.columns == names
        assert {r.doc_id for r in after.select("doc_id").collect()} <= ids
        assert after.count() <= rows
        docs, rows = after, after.count()
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert len(kept) > 0.5 * len(ids)
    # what the stages promise, by plain code: one of each class of near copies, no item of the benchmark, no repeated line
    left = [(i, t) for i, t in kept.items()]
    assert all(i == c for (i, n, c) in _plain_components(left))
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(b in (t or "") for b in bench for t in kept.values())
    seen = Counter(s for t in kept.values() for _, s in line_dedup.lines_of(t))
    assert max(seen.values()) == 1
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == set(kept)
    assert all(r.text == (kept[r.doc_id] or "") and r.n_tokens == len(r.ids or ()) for r in out)


def test_pipeline_drops_copies(spark):
    """Of copies that hold short lines one whole document is left, and no stub of the others."""
    import corpus_pipeline

    rng = random.Random(21)
    words = lambda n: " ".join("".join(rng.choice("abdeinorst") for _ in range(7)) for _ in range(n))
    groups = [[words(1), words(12), "", words(2), words(15), words(3)] for _ in range(8)]
    rows = [(10 * g + k, "\n".join(lines)) for g, lines in enumerate(groups) for k in range(1 + g % 4)]
    rng.shuffle(rows)
    docs = make(spark, rows)
    left = Shelf(spark, "test").put(corpus_pipeline.drop_lines(spark, docs, SF), "left")
    kept = corpus_pipeline.keep_one(spark, left, SF).collect()
    assert {r.doc_id: r.text for r in kept} == {10 * g: "\n".join(lines) for g, lines in enumerate(groups)}
    assert len(kept) == len(groups)


def test_pipeline_against_plain_code(spark):
    """Every stage on all that its predecessor kept, beside a plain version of it."""
    import corpus_pipeline

    rng = random.Random(33)
    own = vocabulary(rng)
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    base = [rng.choice(own) for _ in range(60)]
    near = [" ".join([*base[: 13 * k], *([] if not k else ["anotherword"]), *base[13 * k + (k > 0) :]]) for k in range(4)]
    rows = [*real, *[(5000 + k, t) for k, t in enumerate(near)], (5010, prose(rng, own, 30) + " " + bench[0] + " " + prose(rng, own, 5)), (5011, bench[1]), (5012, None), (5013, ""), (5014, real[3][1]), (None, prose(rng, own, 20)), (5015, "the first line here\nanother one over there\nthe first line here")]
    docs, shelf = make(spark, rows), Shelf(spark, "test")
    now = list(rows)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    for name, stage in corpus_pipeline.STAGES:
        docs = shelf.put(stage(spark, docs, SF), name)
        if name == "toxicity":
            score = model.score([(t or "").encode() for _, t in now])
            now = [r for r, s in zip(now, score, strict=True) if s < 0.5]
        elif name == "line_dedup":
            now = [(i, t) for (i, _, gone, t), times in _plain_lines(now).items() for _ in range(times) if not gone or WORD.search(t or "")]
        elif name == "jaccard_join":
            groups, kept = defaultdict(list), []
            sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := _tokens(t)) else set() for _, t in now]
            root = list(range(len(now)))
            for a, b in itertools.combinations(range(len(now)), 2):
                if sets[a] and sets[b] and root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root = [root[a] if x == root[b] else x for x in root]
            for k, r in enumerate(now):
                (groups[root[k]] if sets[k] else kept).append(r)
            now = kept + [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
        elif name == "decontamination":
            now = [r for r in now if not any(_plain_held(r[1], b) for b in bench if not r[1] or set(_tokens(b)) & set(_tokens(r[1])))]
        else:
            now = [(i, t or "") for i, t in now]
        assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(now), name
    assert {5000, 5012, 5013} <= {i for i, _ in now} and not {5001, 5010, 5011, 5014} & {i for i, _ in now}
    out = corpus_pipeline.run(spark, SF)
    assert {"ids", "n_tokens", "n_byte_pieces"} <= set(out.columns)
