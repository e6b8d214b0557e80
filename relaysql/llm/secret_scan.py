"""Operator 10: secrets by pattern and by token efficiency.

Three patterns (assignments, access keys, hex runs) give the base spans. The
method then looks at maximal runs of base64-like characters: strings made of
words compress well under a byte-pair vocabulary, random ones hardly at all, so a
run of ``MIN_RUN`` characters or more with fewer than ``MAX_RATIO`` characters per
token is a span of kind ``random``. Known digests (hex of the usual lengths,
UUIDs) and identifiers (paths, snake_case, kebab-case and camelCase made of words
and short numbers) are left out, and so is a run that touches a base span: base
spans always stay. The shape of an identifier is not enough: each of its pieces of
``MIN_WORD`` letters or more must be a word, that is, encode to one token for every
``LETTERS_A_TOKEN`` letters at most, and such words must be a third of what it says
(each piece counted once, dates aside); shorter pieces and numbers say nothing
either way.

Texts are scanned whole, in bounded slices of a batch; a vectorised search first
picks the texts that can match at all. Null texts are empty; repeated rows are
each scanned; an empty table gives an empty result; other columns are not read.
Spans are in code points, end exclusive, ordered by start, then by kind.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from relaysql.llm.common import slices, table
from relaysql.session import ship_package

MIN_RUN = 20
MAX_RATIO = 2.0
MIN_WORD = 3
LETTERS_A_TOKEN = 3
SLICE_BYTES = 8 << 20

# The base patterns, each with what a match must also meet.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ["assign", "access", "hex", "random"]

RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}")
# Lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hex.
DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})\Z")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
WORDS = re.compile(r"(?:(?:[A-Z]?[a-z]+|[A-Z]{2,}|\d{1,4})(?:[-_/=+]+|(?=[A-Z])|\Z|(?=\d{1,4}(?:[-_/=+]|\Z))))+\Z")
PIECE = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
DATE = re.compile(r"(?<!\d)(?:19|20)\d\d([-_/])(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])(?!\d)")

# what a text must hold to have any span of a kind
MAYBE = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]|[0-9a-f]{16}"""
         rf"""|[A-Za-z0-9+/_=\-]{{{MIN_RUN}}}""")

_ENCODERS: dict[str, object] = {}


def default_vocabulary() -> tuple[str, str]:
    """Path of the rank file and the splitting pattern of the 50k byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encoder(path: str, pattern: str):
    if path not in _ENCODERS:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def is_word(piece: str, encode) -> bool:
    few = max(1, len(piece) // LETTERS_A_TOKEN)
    return any(len(encode(x)) <= few for x in dict.fromkeys((piece, " " + piece, piece.lower(), " " + piece.lower())))


def made_of_words(body: str, encode) -> bool:
    """Of the shape of an identifier, and its pieces are words."""
    if not WORDS.match(body):
        return False
    pieces = set(PIECE.findall(DATE.sub("", body)))
    said = sum(map(len, pieces))
    if 2 * said < MIN_RUN:                               # the same few pieces again and again, or dates
        return True
    words = [p for p in pieces if len(p) >= MIN_WORD and p.isalpha()]
    return 3 * sum(map(len, words)) >= said and all(is_word(p, encode) for p in words)


def is_known(run: str, encode) -> bool:
    """A digest or an identifier made of words."""
    body = run.strip("=-_/+")
    return bool(DIGEST.match(body) or UUID.match(body)) or body.isdigit() or made_of_words(body, encode)


def spans_of(text: str, encode) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_MIN]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_MIN]
    base = sorted((a, b) for a, _, b in found)
    k = 0
    for m in RUN.finditer(text):
        a, b = m.span()
        while k < len(base) and base[k][1] <= a:
            k += 1
        if any(x < b and y > a for x, y in base[max(0, k - 2):k + 3]):
            continue
        if b - a < MAX_RATIO * len(encode(m[0])) and not is_known(m[0], encode):
            found.append((a, 3, b))
    return sorted(found)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, spans array<struct<kind,start,end>>."""
    ship_package(docs.sparkSession)
    path, pattern = vocabulary or default_vocabulary()
    schema = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        encode = encoder(path, pattern).encode_ordinary
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = part.column("text")
                maybe = pc.fill_null(pc.match_substring_regex(texts, MAYBE), False).to_pylist()
                out = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(texts[i].as_py(), encode)]
                       if hit else [] for i, hit in enumerate(maybe)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, kind)], names=["doc_id", "spans"])

    return docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"CAST(`{text_col}` AS STRING) AS text").mapInArrow(scan, schema)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests are made from the operator's spans with SQL functions."""
    said = "transform({}, s -> concat_ws(':', s.kind, s.start, s.end))"
    base = "filter(spans, s -> s.kind <> 'random')"
    return secret_spans(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", *(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}" for k in KINDS[:3]),
        f"sha2(array_join({said.format(base)}, ','), 256) AS base_sha256",
        f"array_join({said.format('spans')}, ',') AS spans")
