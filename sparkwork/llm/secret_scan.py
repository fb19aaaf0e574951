"""Secret scan: key assignments, access keys and long hex by pattern; other random strings by their token efficiency.

A byte-pair vocabulary holds what text repeats, so words and identifiers take few tokens and random strings take
many.  A string without spaces that gets fewer characters out of a token than ``max_ratio`` is a span of kind
``random``, unless it is a known digest, a number or an identifier, or overlaps a span that a pattern found.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import worker_cache_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
MIN_CHARS = 20  # of a random string
MAX_RATIO = 1.8  # characters a token; of random letters and digits it is about 1.4, of invented words 2 and more
PIECE = 256  # a longer string is measured in pieces of so many characters, all of them
#: fixed values of the contract
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, so the same as all runs of which those of 32 and more stay
KINDS = ["assign", "access", "hex", "random"]
KEYWORDS = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CHARS)
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}  # characters of MD5, SHA-1 and the SHA-2 and SHA-3 family in hex
HEX_STRING = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long,ratio:double>>"


def known(s: str) -> bool:
    """Digests of standard lengths, UUIDs, numbers, and identifiers: two words or more of three letters at least, joined."""
    if (len(s) in DIGEST_LENGTHS and HEX_STRING.fullmatch(s)) or UUID.fullmatch(s):
        return True
    parts = PART.findall(s)
    words = [p for p in parts if p[0].isalpha()]
    if not words:
        return True
    return len(words) > 1 and len(parts) - len(words) <= 1 and min(map(len, words)) >= 3


def ratio(s: str, vocabulary: tiktoken.Encoding) -> float:
    """Characters a token."""
    return len(s) / sum(len(vocabulary.encode_ordinary(s[a : a + PIECE])) for a in range(0, len(s), PIECE))


def scan(text: str, vocabulary: tiktoken.Encoding, min_chars: int = MIN_CHARS, max_ratio: float = MAX_RATIO) -> list[tuple]:
    """(kind, start, end, ratio or None) of every span, in code points, end exclusive, by start and then kind."""
    found = []
    if KEYWORDS.search(text):
        found += [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span(), None) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span(), None) for m in HEX.finditer(text)]
    base = sorted((a, b) for _, a, b, _ in found)
    for m in (CANDIDATE if min_chars == MIN_CHARS else re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % min_chars)).finditer(text):
        s = m[0]
        if any(a < m.end() and m.start() < b for a, b in base) or known(s.strip("-_=/+")):
            continue
        if (value := ratio(s, vocabulary)) < max_ratio:
            found.append(("random", *m.span(), value))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def encoding(path: str) -> tiktoken.Encoding:
    cache = worker_cache_of("secrets")
    if path not in cache:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        cache[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return cache[path]


def find_secrets(docs: DataFrame, vocabulary: str = VOCABULARY, min_chars: int = MIN_CHARS, max_ratio: float = MAX_RATIO) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``spans`` (kind, start, end, ratio), by start and then kind.

    Kinds are assign, access and hex (by pattern, ratio null) and random.  A null or empty text has no spans;
    repeated rows are scanned each, a null id stays null; an empty table gives no rows; columns but doc_id and text are
    not read.  Rows are independent of each other: no shuffle.
    """

    def run(batches):
        encoder = encoding(vocabulary)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())])
        names = ["kind", "start", "end", "ratio"]
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = scan(text.as_py() or "", encoder, min_chars, max_ratio)
                rows.append([dict(zip(names, f, strict=True)) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(rows, pa.list_(kind))], ["doc_id", "spans"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def redact(docs: DataFrame, mark: str = "[secret]", **options) -> DataFrame:
    """``docs`` with every span of ``find_secrets`` replaced by ``mark``; all rows and columns stay.

    Overlapping spans are replaced together; null and empty texts stay as they are.
    """
    at = docs.columns.index("text")
    vocabulary = options.get("vocabulary", VOCABULARY)
    limits = options.get("min_chars", MIN_CHARS), options.get("max_ratio", MAX_RATIO)

    def run(batches):
        encoder = encoding(vocabulary)
        for batch in batches:
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                parts, end = [], 0
                for _, a, b, _ in scan(text or "", encoder, *limits):
                    if a >= end:
                        parts += [text[end:a], mark]
                    end = max(end, b)
                texts.append("".join([*parts, text[end:]]) if parts else text)
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def told(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = told(F.filter(spans, lambda s: s["kind"] != "random"))
    found = find_secrets(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(base, 256).alias("base_sha256"), told(spans).alias("spans"), count("random"),
    )


QUERIES = {"op13_secret_scan": op13_secret_scan}
