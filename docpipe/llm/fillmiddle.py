"""Fill-in-middle: documents cut at two line ends and put in another order."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from docpipe.llm.batches import text_parts
from docpipe.session import ship

#: A line with its break, or the last one without; the group keeps every repetition.
LINES = regex.compile(r"([^\n]*+\n|[^\n]++)*")
#: Longer texts are matched in pieces that end with a line, which gives the same lines.
CHARACTERS_AT_ONCE = 1 << 22
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
RESULT = ("n", "form", "prefix_chars", "middle_chars", "output")


def line_ends(text: str) -> Sequence[int]:
    """Offsets behind every line. One match of the whole text; all repetitions of its group are
    kept, so their number and every offset are there without a loop over the lines."""
    if len(text) <= CHARACTERS_AT_ONCE:
        return LINES.fullmatch(text).ends(1)
    ends: list[int] = []
    start = 0
    while start < len(text):
        stop = text.find("\n", start + CHARACTERS_AT_ONCE - 1) + 1 or len(text)
        # positions of a match count from the beginning of the text
        ends += LINES.fullmatch(text, start, stop).ends(1)
        start = stop
    return ends


def draws(doc_id, seed: int) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 from the id alone, so that a rerun cuts alike."""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def transformed(
    doc_id, text: str, rate: int, spm_rate: int, seed: int, marks: Sequence[str]
) -> tuple[int, str, int | None, int | None, str]:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    ends = line_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(m in text for m in marks) or h3 % 100 >= rate:
        return n, PLAIN, None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[i - 1] if i else 0 for i in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = marks
    if h4 % 100 < spm_rate:
        return n, SPM, a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, PSM, a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(
    docs: DataFrame,
    rate: int = 100,
    spm_rate: int = 50,
    seed: int = 7,
    marks: Sequence[str] = MARKS,
) -> DataFrame:
    """``docs(doc_id, text, ...)`` with all its columns and ``n, form, prefix_chars,
    middle_chars, output``; columns of these names in the input are replaced.

    ``n`` is the number of lines of the text. Prefix and middle end behind two of them, drawn
    from ``doc_id`` and ``seed``; ``rate`` percent of the documents are cut, ``spm_rate`` percent
    of those put the suffix first. ``output`` is the text with the three ``marks``, or the text
    itself where ``form`` is ``plain``: empty texts and those that hold a mark already.
    :func:`restored` gives the text back. Lengths count code points.

    A NULL text is an empty one. A NULL id draws as an empty id. Rows with one id are cut by the
    same draws, each by its own lines. No shuffle: a task keeps one batch of bounded size, or a
    single longer text.
    """
    check_marks(marks)
    marks = tuple(marks)
    ship(docs.sparkSession)
    docs = docs.drop(*RESULT)
    taken = max(map(len, docs.columns))
    # other types of id are drawn from by the text that Spark prints for them
    name = F.col("doc_id").cast("string").alias("name".ljust(taken + 1, "_"))
    text = F.coalesce("text", F.lit("")).alias("text".ljust(taken + 1, "_"))
    rows = docs.select("*", name, text)
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output", T.StringType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.num_columns - 2
            for part in text_parts(batch, own + 1):
                names, texts = part[own].to_pylist(), part[own + 1].to_pylist()
                made = [transformed(i, t, rate, spm_rate, seed, marks) for i, t in zip(names, texts)]
                n, form, prefix, middle, output = zip(*made)
                kept = part.select(range(own))
                results = (
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pc.cast(pa.array(output, pa.large_string()), part.schema.field(own + 1).type),
                )
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, *results], names=[*kept.schema.names, *RESULT]
                )

    return rows.mapInArrow(cut, schema)


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The exact text of an output, from it and its form alone. A cut text holds no mark, so the
    marks part it into what stands before the first, and its three pieces."""
    parts = F.split(output, "|".join(re.escape(m) for m in marks), -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def check_marks(marks: Sequence[str]) -> None:
    """No mark may be able to begin inside another one or at the seam of a text and a mark."""
    firsts = {m[:1] for m in marks}
    if len(marks) != 3 or len(set(marks)) != 3 or "" in firsts:
        raise ValueError("three different marks are needed")
    if any(c in firsts for m in marks for c in m[1:]) or any(
        a != b and b.startswith(a) for a in marks for b in marks
    ):
        raise ValueError("the first character of a mark may stand at its beginning only")
