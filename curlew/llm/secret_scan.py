"""Secret scans: patterns of known shapes, and a token-efficiency test for random strings.

The test: text that resembles what a tokenizer was made for takes few tokens; random strings take many. A string of LEAST or
more characters of the alphabet of keys is a finding when it has at most `ratio` characters per token under a byte-pair
vocabulary (tiktoken). Known digests (hex of the length of a common hash function), UUIDs and numbers are left out. Strings that
are built like identifiers (letters only, words joined by marks, a name with a short number) have to stay below the lower
`letter_ratio`, and to have LEAST_LETTERS characters: unknown words and rare languages take more tokens than known ones, random
letters still more. What a pattern has found is cut out first; the rest of a string is tested by itself.

The vocabulary is a file whose path is a parameter. The driver reads it and broadcasts it; its size is that of the file.
Offsets are code points, ends exclusive. Null texts count as empty and have no findings.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.llm.workspace import bounded_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
RATIO = 2.4
LETTER_RATIO = 1.75
LEAST, LEAST_LETTERS = 16, 20
KINDS = ("assign", "access", "hex", "random")

# The patterns of the contract, hash lengths, and the pattern that the vocabulary's tokenizer splits text by.
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
DIGEST_LENGTHS = frozenset((32, 40, 48, 56, 64, 96, 128))
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LONG_HEX = re.compile(r"[0-9a-f]{16,}")  # HEX takes whole runs, so this finds the same ones of 16 and more
STRING = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z")
PART = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})\Z")
WORDY = re.compile(r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,})+[0-9]{0,4}\Z")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' findings."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def known(string: str) -> bool:
    """Whether a string is a digest, a UUID or a number."""
    return bool(len(string) in DIGEST_LENGTHS and DIGEST.match(string) or UUID.match(string)) or string.isdigit()


def named(string: str) -> bool:
    """Whether a string is built like an identifier."""
    if string.isalpha():
        return True
    parts = [p for p in re.split(r"[+/_=-]+", string) if p]
    return all(PART.match(p) or WORDY.match(p) for p in parts)


def outside(a: int, b: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What is left of a range outside the findings, which are ordered by start."""
    left = []
    for s, _, e in base:
        if s < b and a < e:
            left.append((a, s))
            a = max(a, e)
    return [(s, e) for s, e in [*left, (a, b)] if e - s >= LEAST]


def random_spans(text: str, encode, base: list[tuple[int, int, int]], ratio: float, letter_ratio: float = LETTER_RATIO) -> list[tuple[int, int, int]]:
    found = []
    for m in STRING.finditer(text):
        for a, b in outside(m.start(), m.end(), base):
            string = text[a:b]
            if known(string):
                continue
            most = ratio
            if named(string):
                if len(string) < LEAST_LETTERS:
                    continue
                most = letter_ratio
            if len(string) <= most * len(encode(string)):
                found.append((a, 3, b))
    return found


def encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("secret-scan", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _ranks(spark, vocabulary: str):
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return spark.sparkContext.broadcast(ranks)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, ratio: float = RATIO) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of docs, and found: array of (kind, start, end).

    Null ids stay null; repeated rows are scanned each; other columns of docs play no part, whatever their names. An empty table
    gives an empty table.
    """
    bounded_batches(docs.sparkSession)
    ranks = _ranks(docs.sparkSession, vocabulary)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks.value)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                spans = sorted(base + random_spans(text or "", encode, base, ratio))
                n = [sum(k == x for _, k, _ in base) for x in range(3)]
                rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.list_(kind)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"],
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, found array<struct<kind:string,start:long,`end`:long>>"
    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")).mapInArrow(run, schema)


def redact(docs: DataFrame, text_col: str = "text", count_col: str | None = "n_chars", vocabulary: str = VOCABULARY, ratio: float = RATIO) -> DataFrame:
    """docs with every finding replaced by its kind in brackets; overlapping findings are replaced as one, named by the first.

    All other columns stay, whatever their names; count_col, if docs has it, gets the new length. Null texts stay null, repeated
    rows stay repeated.
    """
    bounded_batches(docs.sparkSession)
    ranks = _ranks(docs.sparkSession, vocabulary)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks.value)
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                if text:
                    base = base_spans(text)
                    done, parts = 0, []
                    for s, k, e in sorted(base + random_spans(text, encode, base, ratio)):
                        if s >= done:
                            parts += [text[done:s], f"[{KINDS[k]}]"]
                        done = max(done, e)
                    text = "".join([*parts, text[done:]])
                out.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    if count_col in docs.columns:
        out = out.withColumn(count_col, F.coalesce(F.length(text_col).cast(docs.schema[count_col].dataType), F.col(count_col)))
    return out
