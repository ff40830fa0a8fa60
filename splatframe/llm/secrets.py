"""Secret scan: fixed patterns, and a guess-cost estimate for values that stand where credentials stand.

A value's cost is the least sum of log10 guesses over its segmentations into dictionary words, dates, repeats,
keyboard walks and brute-force characters (dynamic programming in one pass over the value, so long values cost
time in proportion to their length). Values at or above `least_log10` guesses are added as spans of kind `guess`;
spans of the fixed patterns always stay.

Null and empty texts have no spans. Texts are scanned whole; positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splatframe.llm.common import table

KINDS = ("assign", "access", "hex", "guess")
LEAST_LOG10 = 10.0
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CONTEXT = re.compile(r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|bearer)["']?(?:\x20*[:=]\x20*|\x20+is\x20+)["']?([^\s"'<>,;]{6,})""", re.I | re.A)

#: Frequent words of chosen passwords, most frequent first.
COMMON = (
    "password 123456 qwerty letmein welcome admin login monkey dragon master sunshine princess football baseball "
    "shadow superman iloveyou trustno hello freedom whatever secret summer winter spring autumn love test user "
    "guest root pass access flower hunter ranger buster soccer hockey killer george andrew michael jordan charlie "
    "thomas robert daniel joshua pepper ginger cookie banana orange purple silver golden yellow black white green "
    "blue red star moon tiger eagle lion wolf bear horse mustang ferrari porsche yankees chelsea liverpool london "
    "paris berlin server system database default changeme example sample token key api prod dev staging public private"
).split()
#: Rows of a common keyboard.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d")
LEET = str.maketrans("4@310$57", "aaeiosst")


def _neighbours() -> dict[str, set[str]]:
    at = {c: (x + 0.5 * y, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    return {a: {b for b, (u, v) in at.items() if a != b and abs(u - x) <= 1 and abs(v - y) <= 1} for a, (x, y) in at.items()}


NEAR = _neighbours()


class GuessCost:
    def __init__(self, words: dict[str, int] | None = None) -> None:
        self.words = {w: r for r, w in enumerate(COMMON, 1) if len(w) >= 3} | (words or {})
        self.longest = max(map(len, self.words))

    @staticmethod
    def brute(c: str) -> float:
        return math.log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 100)

    def segments(self, value: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, log10 guesses) of each word, date, repeat and walk; several spans may overlap."""
        low, n = value.lower(), len(value)
        plain = low.translate(LEET)
        for i in range(n):
            for j in range(i + 3, min(n, i + self.longest) + 1):
                rank = self.words.get(low[i:j]) or (self.words.get(plain[i:j]) if len(plain) == n else None)
                if rank:
                    ups = sum(c.isupper() for c in value[i:j])
                    leet = low[i:j] != plain[i:j] and low[i:j] not in self.words
                    yield i, j, math.log10(rank + 1) + (math.log10(2) if ups == 1 or ups == j - i else math.log10(math.comb(j - i, ups)) if ups else 0) + math.log10(4) * leet
        for m in DATE.finditer(value):
            yield m.start(), m.end(), math.log10(150 if len(m[0]) == 4 else 365 * 150)
        i = 0
        while i < n:  # runs of one character, or of steps along the alphabet
            step, j = None, i + 1
            while j < n and abs(d := ord(value[j]) - ord(value[j - 1])) <= 1 and (step is None or ord(value[j]) - ord(value[j - 1]) == step):
                step, j = ord(value[j]) - ord(value[j - 1]), j + 1
                del d
            if j - i >= 3:
                yield i, j, self.brute(value[i]) + math.log10(2 * (j - i))
            i = max(i + 1, j - 1) if j < n else n
        for unit in range(2, 9):  # repeats of a longer unit
            i = 0
            while i + 2 * unit <= n:
                j = i + unit
                while j < n and value[j] == value[j - unit]:
                    j += 1
                if j - i >= 2 * unit:
                    yield i, j, sum(map(self.brute, value[i : i + unit])) + math.log10((j - i) // unit)
                    i = j - unit + 1
                else:
                    i = max(i + 1, j - unit + 1)
        i = 0
        while i < n:  # keyboard walks
            j, turns = i + 1, 0
            while j < n and low[j] in NEAR.get(low[j - 1], ()):
                turns += j - i >= 2 and (ord(low[j]) > ord(low[j - 1])) != (ord(low[j - 1]) > ord(low[j - 2]))
                j += 1
            if j - i >= 4:
                yield i, j, math.log10(47 * (j - i)) + turns * math.log10(4)
            i = max(i + 1, j - 1) if j < n else n

    def log10(self, value: str) -> float:
        n = len(value)
        ends: dict[int, list[tuple[int, float]]] = {}
        for i, j, cost in self.segments(value):
            ends.setdefault(j, []).append((i, cost))
        best = [0.0] * (n + 1)
        for j in range(1, n + 1):
            best[j] = min([best[j - 1] + self.brute(value[j - 1]), *(best[i] + cost + 0.3 for i, cost in ends.get(j, ()))])
        return best[n]


def spans(text: str, cost: GuessCost, least_log10: float = LEAST_LOG10) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed in KINDS."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    values = {m.span(1) for m in CONTEXT.finditer(text)} | {m.span(2) for m in ASSIGN.finditer(text)}
    found += [("guess", a, b) for a, b in values if cost.log10(text[a:b]) >= least_log10]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame, words: dict[str, int] | None = None, least_log10: float = LEAST_LOG10) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>): one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = GuessCost(words)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            out = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(t.as_py() or "", cost, least_log10)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, words: dict[str, int] | None = None, least_log10: float = LEAST_LOG10, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every found span of `text` replaced by `mark`, and n_chars (if any) set anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = GuessCost(words)
        for batch in batches:
            texts = []
            for t in batch.column("text").to_pylist():
                if t:
                    parts, at = [], 0
                    for _, a, b in spans(t, cost, least_log10):
                        if a >= at:
                            parts += [t[at:a], mark]
                        at = max(at, b)
                    t = "".join(parts) + t[at:]
                texts.append(t)
            k = batch.schema.get_field_index("text")
            yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), count("guess"))
