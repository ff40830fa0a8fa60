"""Byte-level BPE as a streaming transducer, and its decoding as an incremental state machine.

In a merge list's encoding of any prefix the last token is the one vocabulary token ending there that is
compatible with the last token of the shorter prefix (a pair is compatible if the merge list leaves it as it is).
So the state after each byte depends on the states of the last `lookahead` bytes alone, where the sufficient
lookahead is the longest token's length: a chain of tokens is stable, and is emitted, once the chains of all those
states share it. What is kept does not grow with the text's length.

That streaming path, stream(), runs only on pre-tokens longer than the lookahead. Shorter ones, which is nearly all
text, are held whole anyway and take another path, within(): a search from the left with backtracking, by the same
rule of compatible pairs. Its output for pre-tokens of at most 64 characters is kept in a bounded cache.

Null and empty texts have no tokens. Special tokens' strings in a text become their ids, as in the library.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splatframe.llm.common import table

CACHED = 400_000
#: Outside these characters the library splits the text, since engines differ on rare classes; for these the classes
#: of letters and digits are written out. Fixed value: the byte-level pre-token pattern.
UNUSUAL = re.compile(r"[^\t\n\r -~¡-ſ‐-‧€]")
LETTERS, DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾"
PRE_TOKENS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^\s{LETTERS}{DIGITS}]+|\s+(?!\S)|\s+")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> dict[str, int]:
    """Letter -> byte in vocabulary files: printable bytes stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.path, model = path, spec["model"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.token_bytes = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if t not in self.special}
        self.ids = {b: i for i, b in self.token_bytes.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocab = model["vocab"]
        self.ranks = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.single = [self.ids[bytes([b])] for b in range(256)]
        #: The sufficient lookahead: no token that ends later can start before the last so many bytes.
        self.lookahead = max(map(len, self.ids))
        self.longest = {}
        for b in self.ids:
            self.longest[b[-1]] = max(self.longest.get(b[-1], 0), len(b))
        self.from_four = {}  # the longest token that starts so
        for b in self.ids:
            if len(b) >= 4:
                self.from_four[b[:4]] = max(self.from_four.get(b[:4], 0), len(b))
        self.fits: dict[tuple[int, int], bool] = {}
        #: Token -> (when the merge list makes it, its left part, its right part); bytes are there from the start.
        self.made = {made: (rank, a, b) for (a, b), (rank, made) in self.ranks.items()} | {i: (-1, i, i) for i in self.single}
        self.alone = {i: self.merged(b) == [i] for i, b in self.token_bytes.items()}
        self.cache: dict[str, tuple[int, ...]] = {}
        self.decoded_bytes = self.token_bytes | {i: s.encode() for s, i in self.special.items()}
        self._library = None

    def merged(self, data: bytes) -> list[int]:
        """The merge list applied step by step, for strings of two tokens' length."""
        out = [self.single[b] for b in data]
        while len(out) > 1:
            best = min(((self.ranks.get(p, (1 << 60, 0))), i) for i, p in enumerate(zip(out, out[1:], strict=False)))
            if best[0][0] == 1 << 60:
                break
            i = best[1]
            out[i : i + 2] = [best[0][1]]
        return out

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merge list leaves the pair as it is: undoing its merges, latest first, on the two sides, no
        two parts that meet at the border may have a merge of their own that comes before the one undone last."""
        if (known := self.fits.get((a, b))) is not None:
            return known
        if len(self.fits) >= 4 * CACHED:
            self.fits.clear()
        left, right, made, ranks, known = a, b, self.made, self.ranks, True
        limit = (1 << 60, 0)
        while True:
            meet = ranks.get((left, right))
            if meet and (meet[0], 0) < limit:
                known = False
                break
            x, y = made[left], made[right]
            if x[0] < 0 and y[0] < 0:
                break
            if x[0] > y[0]:  # a merge at the border wins over one to its right, and loses to one to its left
                limit, left = (x[0], 0), x[2]
            else:
                limit, right = (y[0], 1), y[1]
        self.fits[a, b] = known
        return known

    def stream(self, data: Iterable[int]) -> Iterator[int]:
        """Tokens of one pre-token's bytes, each emitted once no later byte can change it."""
        window = bytearray()  # the bytes from `base` on
        last: dict[int, tuple[int, int]] = {}  # end -> (last token, its start), for ends that still count
        base = end = 0
        for byte in data:
            window.append(byte)
            end += 1
            for size in range(min(len(window), self.longest.get(byte, 1)), 0, -1):
                start = end - size
                token = self.ids.get(bytes(window[-size:]))
                if token is None or start < base or (start != base and start not in last):
                    continue
                if self.compatible(last[start][0], token) if start in last else self.alone[token]:
                    last[end] = (token, start)
                    break
            if end - base > 4 * self.lookahead:
                stable = self._stable(last, base, end)
                if len(stable) > 1:
                    keep = stable.pop()  # stays as the context of what follows
                    yield from (last[e][0] for e in stable)
                    cut = last[stable[-1]][1] + len(self.token_bytes[last[stable[-1]][0]])
                    token, start = last[keep]
                    last = {e: x for e, x in last.items() if e > keep} | {keep: (token, start)}
                    window = window[cut - base :]
                    base = cut
        rest, at = [], end
        while at > base:
            token, at = last[at]
            rest.append(token)
        yield from reversed(rest)

    def within(self, data: bytes) -> list[int]:
        """stream() for what the lookahead spans whole: the chain is found from the left, longest tokens first; the
        encoding of each prefix is one chain only, so an end from which no chain went on is not tried again."""
        out: list[int] = []
        at, n, size, dead = 0, len(data), 0, set()
        ids, most = self.ids, self.from_four
        while at < n:
            size = size or min(n - at, most.get(data[at : at + 4], 3))
            while size > 0:
                token = ids.get(data[at : at + size])
                if token is not None and at + size not in dead and (not out or self.compatible(out[-1], token)):
                    break
                size -= 1
            if size > 0:
                out.append(token)
                at, size = at + size, 0
            else:
                dead.add(at)
                size = len(self.token_bytes[out.pop()])
                at, size = at - size, size - 1 or -1
        return out

    def _stable(self, last: dict[int, tuple[int, int]], base: int, end: int) -> list[int]:
        """Ends of the tokens that the chains of all live states share, from base on."""
        shared: set[int] | None = None
        first: list[int] = []
        for at in range(max(base + 1, end - self.lookahead + 1), end + 1):
            path, e = [], at
            while e > base:
                path.append(e)
                e = last[e][1]
            first = first or path[::-1]
            shared = set(path) if shared is None else shared & set(path)
        return sorted(shared or ())

    def pre_tokens(self, text: str) -> list[bytes | str]:
        if not UNUSUAL.search(text):
            return PRE_TOKENS.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
            self._letters = byte_letters()
        return [bytes(self._letters[c] for c in t) for t, _ in self._library.pre_tokenize_str(text)]

    def __getitem__(self, piece: str | bytes) -> tuple[int, ...]:
        if (known := self.cache.get(piece)) is None:
            data = piece if isinstance(piece, bytes) else piece.encode()
            known = tuple(self.within(data) if len(data) <= self.lookahead else self.stream(data))
            if len(piece) <= 64:
                if len(self.cache) >= CACHED:
                    self.cache.clear()
                self.cache[piece] = known
        return known

    def encode(self, text: str) -> list[int]:
        parts = self.split_special.split(text) if self.split_special and any(s in text for s in self.special) else [text]
        ids: list[int] = []
        cache = self.cache
        for part in parts:
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids += chain.from_iterable([cache.get(p) or self[p] for p in self.pre_tokens(part)])
        return ids

    def decode(self, ids: Iterable[int], step: int = 65536) -> Iterator[str]:
        """Text of ids in steps; a character cut by a token's end waits in the decoder, a bad byte becomes U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        ids = iter(ids)
        table_ = self.decoded_bytes
        while data := [table_[i] for i in islice(ids, step)]:
            yield machine.decode(b"".join(data))
        yield machine.decode(b"", True)


@functools.cache
def transducer(path: str) -> Transducer:
    """One for each Python worker, which keeps its cache from task to task."""
    return Transducer(path)


def digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per document: number of tokens, digest of its ids and of the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = transducer(tokenizer_path)
        names = [str(i) for i in range(1 + max(bpe.decoded_bytes))]
        for batch in batches:
            n, a, b = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py() or "")
                n.append(len(ids))
                a.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                digest = hashlib.sha256()
                for part in bpe.decode(ids):
                    digest.update(part.encode())
                b.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids): the token ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = transducer(tokenizer_path)
        for batch in batches:
            ids = [bpe.encode(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = transducer(tokenizer_path)
        for batch in batches:
            texts = ["".join(bpe.decode(ids.as_py() or [])) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
