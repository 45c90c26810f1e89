"""Secrets in texts: fixed patterns, and strings that nothing around them helps to compress."""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from docpipe.llm.batches import text_parts
from docpipe.session import ship

# The fixed patterns and their least sizes. Fixed values.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "novel")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: What makes a context sensitive, beside the words of the patterns.
SENSITIVE = re.compile(
    r"pass(?:word|wd|phrase)|secret|token|api[_-]?key|private[_ -]?key|access[_-]?key"
    r"|credential|bearer|authorization|signature",
    re.IGNORECASE | re.ASCII,
)
SENSITIVE_WORDS = ("pass", "secret", "token", "key", "credential", "bearer", "authori", "signature")
#: A candidate starts at most so many characters behind a sensitive word, or in the line of the
#: candidate before it or in the next line.
REACH = 64
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}", re.ASCII)
#: So many characters on either side are the surrounding code.
SURROUNDING = 512
#: Least marginal compressed bytes per character of a candidate.
NOVELTY = 0.8
#: Or least share of what a random string of its length over its characters costs: the compressor
#: packs long strings over few characters, however random they are.
RANDOM_SHARE = 0.92
_DIGITS, _UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Letters and digits that random strings are usually made of, few first.
ALPHABETS = tuple(
    frozenset(x)
    for x in (
        _DIGITS + "abcdef", _DIGITS + "ABCDEF", _UPPER + "234567", _UPPER.lower() + "234567",
        _DIGITS + _UPPER.lower(), _DIGITS + _UPPER, _DIGITS + _UPPER + _UPPER.lower(),
    )
)
# Words that names in code are made of; they prime the compressor.
IDENTIFIERS = (
    "access account address admin api app application auth authorization base bearer bucket build "
    "cache certificate client cloud code config configuration connection content context cookie "
    "credential data database default development digest document domain encoding endpoint "
    "environment example expires export file filter format function github handler hash header "
    "host identifier import index input instance integer interface internal key language length "
    "library license local login manager message method model module name namespace network null "
    "number object option origin output package parameter parser passphrase password path pattern "
    "payload permission port prefix private production project property protocol provider public "
    "query reference region register request resource response result return role schema script "
    "secret security server service session setting signature source status storage string suffix "
    "system table target template test text timeout timestamp token type undefined update upload "
    "url user username validation value variable version window workspace "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 your_ my_ xxxxxxxxxxxxxxxx "
    "________________ ---------------- ================"
)

_HEX_MARK = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns as ``(start, end, kind)``, in code points. A pattern is run
    only where a plain search finds what every match must contain."""
    spans: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [
            (*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN
        ]
    if "AKIA" in text:
        spans += [
            (*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS
        ]
    marks = text.encode("latin-1", "replace").translate(_HEX_MARK)
    run = b"1" * LEAST_HEX
    at = marks.find(run)
    while at >= 0:
        end = marks.find(b"0", at)
        end = len(marks) if end < 0 else end
        spans.append((at, end, "hex"))
        at = marks.find(run, end)
    return sorted(spans, key=_order)


def _order(span: Span):
    return span[0], KINDS.index(span[2])


def marginal_bytes(candidate: str, before: str, after: str) -> int:
    """What the candidate adds to the compressed size, given the identifiers and the code around."""
    primer = f"{IDENTIFIERS} {after} {before}".encode("utf-8", "replace")
    known = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    tool = zstandard.ZstdCompressor(level=9, dict_data=known, write_content_size=False)
    return len(tool.compress(candidate.encode())) - len(tool.compress(b""))


@lru_cache(maxsize=4096)
def random_bytes(alphabet: str, length: int) -> int:
    """Compressed size of a random string, always the same one."""
    value = "".join(random.Random(length).choices(alphabet, k=length)).encode()
    tool = zstandard.ZstdCompressor(level=9, write_content_size=False)
    return len(tool.compress(value)) - len(tool.compress(b""))


def is_novel(value: str, before: str, after: str, novelty: float = NOVELTY) -> bool:
    """Whether the candidate stays about as long as it is, or as a random string of its kind."""
    marginal = marginal_bytes(value, before, after)
    if marginal >= novelty * len(value):
        return True
    if marginal < novelty * len(value) / 2:  # below four bits a character
        return False
    used = set(value.rstrip("="))
    marks = used & set("+/_=-")
    kind = next(x for x in ALPHABETS if used - marks <= x) | marks
    return marginal >= RANDOM_SHARE * random_bytes("".join(sorted(kind)), len(value))


def _next_line_end(text: str, at: int) -> int:
    end = text.find("\n", at)
    end = text.find("\n", end + 1) if end >= 0 else end
    return len(text) if end < 0 else end


def novel_spans(text: str, known: list[Span], novelty: float = NOVELTY) -> list[Span]:
    """Strings of mixed characters behind a sensitive word that stay as long as they are when
    compressed with everything around them as dictionary, or as a random string of their kind
    does. A string of mixed characters carries the context on to the end of the next line, so
    that a key over many lines is found whole. Those that touch a known span are left to it."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE_WORDS):
        return []
    found: dict[int, Span] = {}
    seen: set[int] = set()
    done = reached = 0
    for word in SENSITIVE.finditer(text):
        at, limit = word.end(), word.end() + REACH
        while (m := CANDIDATE.search(text, at)) and m.start() <= limit:
            at = m.end()
            start, end = m.span()
            if start in seen:  # everything from here on to ``done`` has been looked at
                at, limit = max(at, done), max(limit, reached)
                continue
            seen.add(start)
            value = m[0]
            if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
                done, reached = max(done, at), max(reached, limit)
                continue
            limit = max(limit, _next_line_end(text, end))
            done, reached = max(done, at), max(reached, limit)
            if any(s < end and start < e for s, e, _ in known):
                continue
            before, after = text[max(0, start - SURROUNDING) : start], text[end : end + SURROUNDING]
            if is_novel(value, before, after, novelty):
                found[start] = start, end, "novel"
    return list(found.values())


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_text(text: str | None) -> tuple[int, int, int, int, str, str]:
    base = base_spans(text or "")
    novel = novel_spans(text or "", base)
    counts = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
    digest = hashlib.sha256(joined(base).encode()).hexdigest()
    return (*counts, len(novel), digest, joined(sorted(base + novel, key=_order)))


COLUMNS = ["n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]
TYPES = [pa.int64()] * 4 + [pa.string()] * 2


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans`` for every row.

    ``spans`` lists ``kind:start:end`` by start, then kind, in code points with the end
    exclusive; ``base_sha256`` is the digest of the same list without the novel ones. Texts are
    scanned whole where they are read, nothing is shuffled. A NULL text is an empty one and
    has no spans. Ids may be NULL or repeat; other columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch):
                found = zip(*[scan_text(t) for t in part["text"].to_pylist()])
                columns = [pa.array(c, t) for c, t in zip(found, TYPES)]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *columns], names=["doc_id", *COLUMNS]
                )

    return rows.mapInArrow(
        scanned,
        f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_novel bigint,"
        " base_sha256 string, spans string",
    )


def spans_table(found: DataFrame) -> DataFrame:
    """One row per span: ``doc_id, kind, start, end``."""
    rows = found.where("spans <> ''").select("doc_id", F.explode(F.split("spans", ",")).alias("s"))
    return rows.select("doc_id", F.split("s", ":").alias("p")).selectExpr(
        "doc_id", "p[0] AS kind", "CAST(p[1] AS BIGINT) AS start", "CAST(p[2] AS BIGINT) AS `end`"
    )
