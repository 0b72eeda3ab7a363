"""Personal data: fixed patterns, and a learnt tagger that adds spans the patterns miss.

The patterns find e-mail addresses, IP addresses, payment cards and phone
numbers.  A character-level bidirectional LSTM with CRF transitions is trained
on a bounded sample of text around such places, labelled by the patterns, and on
the same places rewritten in other notations (a phone number without its plus,
dots in a card, spaces around an at sign).

A span of any kind holds a digit or an at sign, so texts are read around those:
every stretch within ``REACH`` characters of one is covered by overlapping
windows.  Where windows overlap, their tag scores are averaged, each weighing by
its distance from its window's end, and one best tag sequence is found for the
whole stretch, so spans neither split nor collide at window ends.  A decoded
span is added if it looks like its kind (enough digits or parts) and touches no
pattern span.

Defined results: a null text counts as empty and has no span; texts are read
whole; pattern spans of different kinds may overlap and all stay; where there is
nothing to learn from, invented places alone are learnt; repeated rows give
repeated results; an empty table gives no rows; further columns are ignored or
carried.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import bounded_sample, map_texts
from kiln.llm.tagger import PAD, Tagger, char_ids

KINDS = ("email", "ip", "card", "phone")
WINDOW, REACH = 96, 48
SAMPLE, PLACES = 1_200, 3   # texts, about, that are learnt from, and pattern spans in each
EPOCHS, STEPS = 5, 350      # passes over the examples, more where these make fewer steps
TAGS = 1 + 2 * len(KINDS)   # outside; begin and inside of every kind

_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive, and never from within a run of digits: the same matches in linear time
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile("[0-9@]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and non-overlapping per kind, in the order of ``KINDS``."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:              # only an at sign can make an address: the run before it is its local part
        first = at
        while first > end and text[first - 1] in _LOCAL:
            first -= 1
        host = _HOST.match(text, at + 1) if first < at else None
        if host:
            end = host.end()
            out.append(("email", first, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def written_spans(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def plausible(kind: str, s: str) -> bool:
    """Whether a decoded span has the parts that its kind needs."""
    digits = sum(c in "0123456789" for c in s)
    if kind == "email":
        return bool(re.fullmatch(r"\S{1,64} ?@ ?[\w-]+( ?\. ?[\w-]+)+", s))
    if kind == "ip":
        parts = re.split(r"[^0-9]+", s.strip("[]() "))
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        plain = re.sub("[^0-9]", "", s)
        return 13 <= digits <= 19 and luhn(plain) and not re.search("[^0-9 ./-]", s)
    return 10 <= digits <= 15 and bool(re.search("[ ().-]", s)) and not re.search("[^0-9 ()+./-]", s)


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text within reach of a digit or an at sign."""
    out: list[tuple[int, int]] = []
    for m in _MARK.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def trimmed(text: str, kind: str, a: int, b: int) -> Span:
    """The span without characters at its ends that values of its kind do not begin or end with."""
    def fits(c: str, more: str) -> bool:
        return c in "0123456789" or c in more if kind != "email" else c.isalnum() or c in _LOCAL

    while a < b and not fits(text[a], "+(" if kind == "phone" else ""):
        a += 1
    while a < b and not fits(text[b - 1], ""):
        b -= 1
    return kind, a, b


def decode(tagger: Tagger, texts: list[str], batch: int = 1_000) -> list[list[Span]]:
    """Spans that the tagger finds in every text."""
    places = [(t, a, b) for t, text in enumerate(texts) for a, b in stretches(text)]
    ids = [char_ids(texts[t][a:b]) for t, a, b in places]
    windows = [(k, s) for k, x in enumerate(ids) for s in range(0, max(1, len(x) - WINDOW // 2), WINDOW // 2)]
    weight = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]
    scores = [np.zeros((len(x), TAGS), np.float32) for x in ids]
    weights = [np.zeros((len(x), 1), np.float32) for x in ids]
    for at in range(0, len(windows), batch):
        own = windows[at:at + batch]
        padded = np.full((len(own), WINDOW), PAD, dtype=np.int16)
        for r, (k, s) in enumerate(own):
            part = ids[k][s:s + WINDOW]
            padded[r, :len(part)] = part
        e = tagger.emissions(padded)
        for r, (k, s) in enumerate(own):
            n = min(WINDOW, len(ids[k]) - s)
            scores[k][s:s + n] += e[r, :n] * weight[:n]
            weights[k][s:s + n] += weight[:n]
    out: list[list[Span]] = [[] for _ in texts]
    for (t, a, _), e, w in zip(places, scores, weights, strict=True):
        if (e.argmax(axis=1) == 0).all():
            continue                    # no tag but "outside" leads anywhere
        tags = tagger.viterbi(e / w)
        begin = np.flatnonzero(tags % 2 == 1)
        for s in begin:
            kind = int(tags[s] + 1) // 2
            stop = s + 1
            while stop < len(tags) and tags[stop] == 2 * kind:
                stop += 1
            out[t].append(trimmed(texts[t], KINDS[kind - 1], a + int(s), a + int(stop)))
    return [[s for s in spans if s[1] < s[2]] for spans in out]


def find(tagger: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(pattern spans, all spans) of every text."""
    out = []
    for text, extra in zip(texts, decode(tagger, texts), strict=True):
        base = pattern_spans(text)
        more = [(k, a, b) for k, a, b in extra
                if plausible(k, text[a:b]) and not any(a < y and x < b for _, x, y in base)]
        out.append((base, base + more))
    return out


def _invented(rng: random.Random) -> tuple[str, str]:
    """A kind and a value of it, in one of the notations to be learnt."""
    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def letters(n: int) -> str:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    kind = rng.choice(KINDS)
    if kind == "email":
        name = letters(rng.randint(1, 9)) + rng.choice(["", ".", "_", "-"]) + rng.choice([letters(3), digits(2)])
        host = letters(rng.randint(2, 8)) + rng.choice(["", digits(1)]) + "." + rng.choice(["com", "org", "net", "example.com", letters(2)])
        return kind, name + rng.choice(["@", "@", "@", " @ "]) + host
    if kind == "ip":
        return kind, rng.choice([".", ".", ".", " . "]).join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        first = digits(rng.choice([15, 15, 15, 14]))
        number = next(first + str(c) for c in range(10) if luhn(first + str(c)))
        sep = rng.choice(["", "", " ", "-", "."])
        return kind, sep.join(number[i:i + 4] for i in range(0, len(number), 4)) if sep else number
    area, a, b = digits(3), digits(3), digits(4)
    return kind, rng.choice([f"+{rng.randint(1, 99)} ({area}) {a}-{b}", f"+{rng.randint(1, 99)} {area} {a} {b}", f"({area}) {a}-{b}",
                             f"{area}-{a}-{b}", f"{area}.{a}.{b}", f"00{rng.randint(1, 99)} {area} {a} {b}", f"+1{area}{a}{b}"])


def _examples(fragments: list[str], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Windows with tags: every fragment as the patterns label it, and once more with an invented value in it."""
    rng = random.Random(seed)
    ids, tags = [], []

    def add(text: str, spans: list[Span]) -> None:
        x = np.full(WINDOW, PAD, dtype=np.int16)
        y = np.zeros(WINDOW, dtype=np.int64)
        part = char_ids(text[:WINDOW])
        x[:len(part)] = part
        for kind, a, b in sorted(spans, key=lambda s: s[1] - s[2]):     # longer ones first, no overlap
            if b <= WINDOW and not y[a:b].any():
                y[a:b] = 2 * KINDS.index(kind) + 2
                y[a] -= 1
        ids.append(x)
        tags.append(y)

    for f in fragments or [""]:
        add(f, pattern_spans(f))
        plain = [f, *re.split(r"\s+", re.sub(r"\S*[0-9@]\S*", "", f))]
        for _ in range(2):
            kind, value = _invented(rng)
            words = rng.sample(plain[1:], min(len(plain) - 1, rng.randint(0, 6)))
            before = " ".join(words[:len(words) // 2])[:40]
            before += rng.choice([" ", " ", "\n", ": ", "("]) if before else ""
            after = rng.choice([" ", " ", ".", ",", "!!", "###", "\n", ""])
            after += " ".join(words[len(words) // 2:]) if after else ""
            add(before + value + after, [(kind, len(before), len(before) + len(value))])
        number = rng.choice([f"{rng.randint(0, 20)}.{rng.randint(0, 9)}", f"{rng.getrandbits(rng.choice([64, 128])):x}",
                             str(rng.randint(0, 10 ** rng.randint(1, 9))), f"{rng.randint(1900, 2100)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"])
        words = rng.sample(plain[1:], min(len(plain) - 1, 4))
        add(" ".join([*words[:2], number, *words[2:]]), [])
    return np.array(ids), np.array(tags)


def train(fragments: list[str]) -> Tagger:
    allowed = np.ones((TAGS, TAGS), dtype=bool)
    for k in range(len(KINDS)):
        inside = 2 * k + 2
        allowed[:, inside] = False
        allowed[[inside - 1, inside], inside] = True
    first = np.array([t == 0 or t % 2 == 1 for t in range(TAGS)])
    tagger = Tagger(allowed, first)
    ids, tags = _examples(fragments)
    tagger.fit(ids, tags, epochs=max(EPOCHS, min(10 * EPOCHS, STEPS * 64 // len(ids))))
    return tagger


def learnt(docs: DataFrame, text_col: str = "text") -> Tagger:
    """A tagger for a table: learns from some places in each of about ``SAMPLE`` different texts, mostly such with marks."""
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).where(F.col("text").isNotNull())
    rows = rows.withColumn("marked", F.col("text").rlike("[0-9@]"))
    sample = bounded_sample(rows, "marked", {True: 0.8 * SAMPLE, False: 0.2 * SAMPLE}).withColumn(
        "key", F.xxhash64(F.lit("place"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, key in zip(batch.column("text").to_pylist(), batch.column("key").to_pylist(), strict=True):
                rng = random.Random(key)
                spans, marks = pattern_spans(text), stretches(text)
                centres = [a for _, a, _ in rng.sample(spans, min(PLACES, len(spans)))]
                centres.append(rng.choice(marks)[0] + REACH if marks else rng.randrange(len(text) + 1))
                for centre in centres:
                    first = max(0, centre - rng.randint(10, 60))
                    out.append(text[first:first + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["fragment"])

    got = sample.select("text", "key").mapInArrow(run, "fragment string").toArrow()
    return train(sorted(got.column("fragment").to_pylist()))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts of pattern spans, their digest, all spans) of every row."""
    tagger = learnt(docs, text_col)

    def run(texts: list[str]) -> dict:
        found = find(tagger, texts)
        out: dict[str, list] = {f"n_{k}": [sum(s[0] == k for s in base) for base, _ in found] for k in KINDS}
        out["base_sha256"] = [hashlib.sha256(written_spans(base).encode()).hexdigest() for base, _ in found]
        out["spans"] = [written_spans(spans) for _, spans in found]
        return out

    return map_texts(docs, text_col, {id_col: id_col},
                     {**{f"n_{k}": "long" for k in KINDS}, "base_sha256": "string", "spans": "string"}, run)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first names the place."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"<{kind.upper()}>"]
        end = max(end, b)
    return "".join(out) + text[end:]


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all spans replaced by their kinds; null texts stay null."""
    tagger = learnt(docs, text_col)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != text_col]).alias("__row"),
                       F.col(f"`{text_col}`").isNull().alias("__null"), F.col(f"`{text_col}`").alias("__t"))

    def run(texts: list[str]) -> dict:
        return {"__text": [redacted(t, spans) for t, (_, spans) in zip(texts, find(tagger, texts), strict=True)]}

    out = map_texts(rows, "__t", {"__row": "__row", "__null": "__null"}, {"__text": "string"}, run)
    text = F.when(~F.col("__null"), F.col("__text"))
    return out.select(*[text.alias(c) if c == text_col else F.col(f"__row.`{c}`") for c in names])
