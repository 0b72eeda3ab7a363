from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from kiln.llm import pii
from kiln.llm.pii import KINDS, decode, find, luhn, pattern_spans, personal_data, redact, redacted, stretches, written_spans
from kiln.llm.tagger import Tagger, char_ids

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]


def test_patterns_equal_the_plain_expressions(docs):
    rng = random.Random(1)
    texts = [r["text"] for r in docs.collect()]
    texts += ["".join(rng.choices("@a.1+ -(9%@.", k=60)) for _ in range(20_000)]
    texts += ["4539 1488 0343 6467", "4539148803436467" * 2, "1.2.3.4.5.6.7.8", "256.1.1.1", "+1" * 9, "a@b", "a@b.c@d.e", "é@b.co"]
    for t in texts:
        assert pattern_spans(t) == plain(t)


def test_patterns_are_linear():
    for t in ("1" * 200_000, "a" * 200_000, "@" * 200_000, "1." * 100_000, "+1 " * 60_000, "a@" * 100_000):
        pattern_spans(t)


def small_tagger(seed=0):
    allowed = np.ones((pii.TAGS, pii.TAGS), dtype=bool)
    return Tagger(allowed, np.ones(pii.TAGS, dtype=bool), embedding=3, hidden=4, seed=seed)


def test_gradients():
    tagger = small_tagger()
    for k, v in tagger.p.items():
        tagger.p[k] = v.astype(np.float64)
    rng = np.random.default_rng(1)
    ids, tags = rng.integers(0, 99, (3, 7)).astype(np.int16), rng.integers(0, pii.TAGS, (3, 7))
    _, grads = tagger.loss_and_grads(ids, tags)
    for k, g in grads.items():
        flat = tagger.p[k].reshape(-1)
        for j in rng.choice(len(flat), min(6, len(flat)), replace=False):
            old, step = flat[j], 1e-3
            flat[j] = old + step
            up, _ = tagger.loss_and_grads(ids, tags)
            flat[j] = old - step
            down, _ = tagger.loss_and_grads(ids, tags)
            flat[j] = old
            assert abs((up - down) / (2 * step) - g.reshape(-1)[j]) < 2e-3, k


def test_viterbi_equals_trying_all_sequences():
    from itertools import product
    allowed = np.array([[1, 1, 0], [1, 1, 1], [1, 0, 1]], dtype=bool)
    tagger = Tagger(allowed, np.array([True, True, False]), embedding=2, hidden=2)
    tagger.p["trans"] = np.random.default_rng(2).normal(0, 1, (3, 3)).astype(np.float32)
    e = np.random.default_rng(3).normal(0, 1, (5, 3)).astype(np.float32)
    trans = tagger.p["trans"] + tagger.block

    def score(s):
        return tagger.block_first[s[0]] + e[0, s[0]] + sum(trans[a, b] + e[t + 1, b] for t, (a, b) in enumerate(zip(s, s[1:])))

    assert tuple(tagger.viterbi(e)) == max(product(range(3), repeat=5), key=score)


def test_tagger_learns_the_kinds_and_their_other_notations(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tagger = pii.learnt(docs)
    texts = [r["text"] for r in docs.collect()]
    base, found = [plain(t) for t in texts], decode(tagger, texts)
    right = sum(len(set(a) & set(b)) for a, b in zip(base, found, strict=True))
    assert right >= 0.9 * sum(map(len, base))
    extra = sum(len(spans) - len(own) for own, spans in find(tagger, texts))
    assert extra <= 0.02 * sum(map(len, base)) + 1
    # a value at every place of the overlapping windows is found whole and once
    for k in range(7, 120, 7):
        text = "word " * 30 + "1" + " word" * (k // 5) + "x" * (k % 5) + " 170.106.47.218 and so on " + "word " * 30
        spans = [s for s in decode(tagger, [text])[0] if s[0] == "ip"]
        at = text.index("170.")
        assert spans == [("ip", at, at + 14)]


def test_stretches_cover_marks():
    text = "a" * 200 + "1" + "b" * 300 + "@" + "c" * 40 + "2"
    assert stretches(text) == [(152, 249), (453, len(text))]
    assert stretches("no mark") == []
    assert char_ids("aé\n\U0001F600").tolist() == [65, 95, 97, 96]


def test_redacted():
    assert redacted("x 12 y", [("card", 2, 4)]) == "x <CARD> y"
    assert redacted("abcdef", [("ip", 1, 4), ("phone", 2, 5)]) == "a<IP>f"


def test_awkward_rows(awkward, no_docs):
    rows = personal_data(awkward).collect()
    texts = [r["text"] or "" for r in awkward.collect()]
    want = sorted(hashlib.sha256(written_spans(plain(t)).encode()).hexdigest() for t in texts)
    assert sorted(r["base_sha256"] for r in rows) == want
    one = next(r for r in rows if r["doc_id"] == 14)
    assert [one[f"n_{k}"] for k in KINDS] == [1, 1, 1, 1]
    out = redact(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    by = {r["doc_id"]: r["text"] for r in out.collect()}
    assert by[14] == "Mail me: <EMAIL> or <IP>, <PHONE>, <CARD>." and by[1] is None
    clean = {r["doc_id"]: r["text"] for r in awkward.collect()}
    assert by[4] == clean[4] and by[13] == clean[13]
    assert personal_data(no_docs).count() == 0 and redact(no_docs).count() == 0
