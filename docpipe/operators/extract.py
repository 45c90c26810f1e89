"""One structured record per document, from a pluggable model.

The outcome of a document is either a ``response`` (VARIANT) or an ``error`` (text), never
both. A failing document becomes an error row; it does not fail the job unless asked to.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from docpipe.functions.sqltext import quoted

NULL_INPUT = "NULL_INPUT"
NO_FIELDS_FOUND = "NO_FIELDS_FOUND"
MALFORMED_JSON = "MALFORMED_JSON"
WRONG_RESULT_COUNT = "WRONG_RESULT_COUNT"
NOT_TEXT = "NOT_TEXT"

ANSWER = "result string, errorMessage string"
# A text with more than one part in so many of all rows counts as hot.
HOT_SHARES = 1000

OUTCOME_COLUMNS = ("input", "response", "error")

Caller = Callable[[Sequence[str]], Sequence[str | None]]


@dataclass(frozen=True)
class ExpressionModel:
    """Model made of column expressions: ``build(df, text, result)`` adds the column
    ``result`` with the JSON text for the column ``text``."""

    build: Callable[[DataFrame, str, str], DataFrame]

    def add_answer(self, df: DataFrame, text: str, fail_on_error: bool) -> DataFrame:
        kept = df.columns
        # A text that "is not deterministic" keeps the optimizer from moving the model below a
        # limit or a filter that was put in front of it.
        guarded = F.when(F.rand(0) + 1 > 0, F.col(text)).alias(text)
        df = df.select(*[guarded if c == text else F.col(quoted(c)) for c in kept])
        problem = F.when(F.col(text).isNull(), F.lit(NULL_INPUT)).when(
            F.col("_json").isNull(), F.lit(NO_FIELDS_FOUND)
        )
        answer = F.struct(F.col("_json").alias("result"), problem.alias("errorMessage"))
        # The condition always holds. It stands for "not deterministic": a filter on the
        # outcome then stays above the model instead of being pushed below it, where it would
        # read the text a second time, once for every mention of a value.
        once = F.when(F.rand(0) + 1 > 0, answer)
        return self.build(df, text, "_json").select(*kept, once.alias("_answer"))


@dataclass(frozen=True)
class CallableModel:
    """Model behind a Python callable, for clients that Spark has no expression for.

    ``factory`` runs once per task and returns a function from a list of texts to a list of
    JSON texts of the same length; a factory that raises fails the job, since then nothing
    works. A batch that raises or miscounts is tried again in halves, so that one bad document
    costs one error row and few calls; a single text is tried ``tries`` times, with a growing
    ``pause`` in seconds in between. When whole batches keep failing, each costs at most
    ``2 * batch_size - 1`` calls of falling size. ``in_flight`` calls run at a time in a task,
    for clients that wait for a service; such a client must allow calls from several threads.
    An answer that is not text, or text that is not valid Unicode, is an error of its document.
    """

    factory: Callable[[], Caller]
    batch_size: int = 64
    in_flight: int = 1
    tries: int = 1
    pause: float = 0.5

    def add_answer(self, df: DataFrame, text: str, fail_on_error: bool) -> DataFrame:
        return df.withColumn("_answer", self.udf()(F.col(text), F.lit(fail_on_error)))

    def udf(self):
        """``f(text, fail_on_error)``; never deterministic, so that a reference to both
        fields of the answer does not become two calls."""
        factory, options = self.factory, (self.batch_size, self.in_flight, self.tries, self.pause)
        client: list[Caller] = []

        @F.pandas_udf(ANSWER)
        def answer(text: pd.Series, fail_on_error: pd.Series) -> pd.DataFrame:
            if not client:
                client.append(factory())
            strict = bool(len(fail_on_error)) and bool(fail_on_error.iloc[0])
            return call_in_batches(client[0], text, strict, *options)

        return answer.asNondeterministic()


def call_in_batches(
    call: Caller, text: pd.Series, strict: bool, size: int, in_flight: int, tries: int, pause: float
) -> pd.DataFrame:
    """Answers for one Arrow batch, ``size`` texts per call; null texts are not sent."""
    results = pd.Series([None] * len(text), dtype=object)
    errors = pd.Series([NULL_INPUT] * len(text), dtype=object)
    sent = [i for i, value in enumerate(text) if value is not None]
    chunks = [sent[start : start + size] for start in range(0, len(sent), size)]

    def answers(chunk: list[int]):
        return _call_chunk(call, [text.iloc[i] for i in chunk], tries, pause)

    if in_flight > 1:
        with ThreadPoolExecutor(in_flight) as pool:
            answered = list(pool.map(answers, chunks))
    else:
        answered = map(answers, chunks)
    for chunk, pairs in zip(chunks, answered):
        for i, (result, error) in zip(chunk, pairs):
            results[i], errors[i] = result, error
    if strict:
        failed = errors.dropna()
        if len(failed):
            raise RuntimeError(f"model call failed: {failed.iloc[0]}")
    return pd.DataFrame({"result": results, "errorMessage": errors})


def _call_chunk(
    call: Caller, texts: list[str], tries: int, pause: float
) -> list[tuple[str | None, str | None]]:
    for n in range(max(tries, 1) if len(texts) == 1 else 1):
        if n:
            time.sleep(pause * 2 ** (n - 1))
        try:
            answers = list(call(texts))
            if len(answers) != len(texts):
                raise ValueError(WRONG_RESULT_COUNT)
            return [_checked(a) for a in answers]
        except Exception as problem:  # noqa: BLE001 - any client error is data here
            failure = f"{type(problem).__name__}: {problem}"
    if len(texts) == 1:
        return [(None, failure.encode("utf-8", "replace").decode())]
    half = len(texts) // 2
    return [
        pair for part in (texts[:half], texts[half:]) for pair in _call_chunk(call, part, tries, pause)
    ]


def _checked(answer) -> tuple[str | None, str | None]:
    if answer is None:
        return None, NO_FIELDS_FOUND
    if not isinstance(answer, str):
        return None, f"{NOT_TEXT}: {type(answer).__name__}"
    try:
        answer.encode("utf-8")
    except UnicodeEncodeError:
        return None, f"{NOT_TEXT}: invalid Unicode"
    return answer, None


def extract_fields(
    df: DataFrame,
    model: ExpressionModel | CallableModel,
    text: str = "text",
    fail_on_error: bool = False,
    partitions: int | None = None,
    distinct_texts: bool = False,
) -> DataFrame:
    """``df`` with ``text`` replaced by ``input``, ``response`` and ``error``.

    ``partitions`` spreads the documents evenly (by count, not by key) before a slow model.
    ``distinct_texts`` calls the model once per distinct text; worth it when a call costs
    more than a shuffle of the texts.
    """
    kept = [c for c in df.columns if c != text]
    clash = [c for c in kept if c in OUTCOME_COLUMNS]
    if clash:
        raise ValueError(f"columns {clash} would be hidden by the outcome columns")
    if partitions:
        df = df.repartition(partitions)
    if distinct_texts:
        called = _called_once_per_text(df, model, text, fail_on_error)
    else:
        called = model.add_answer(df, text, fail_on_error)
    parsed = called.select(
        *kept,
        F.col(text).alias("input"),
        F.col("_answer.errorMessage").alias("_error"),
        F.try_parse_json(F.col("_answer.result")).alias("_response"),
    )
    error = F.coalesce(
        F.col("_error"), F.when(F.col("_response").isNull(), F.lit(MALFORMED_JSON))
    )
    response = F.when(F.col("_error").isNull(), F.col("_response"))
    if fail_on_error:
        failure = F.raise_error(F.concat(F.lit("extraction failed: "), error))
        response = F.when(error.isNull(), response).otherwise(failure)
        error = F.when(error.isNotNull(), failure.cast("string"))
    return parsed.select(*kept, "input", response.alias("response"), error.alias("error"))


def _called_once_per_text(df, model, text, fail_on_error) -> DataFrame:
    """One call per distinct text, joined back to all its copies.

    Copies collapse map-side before the texts are shuffled, and a text is shuffled once: its copies
    meet it by their key alone. That would bring all copies of a text into one task, so those with
    more than a thousandth of all rows, which are fewer than a thousand texts, are spread over
    several: their answer is repeated once per share. That bound is what allows to broadcast their
    keys. NULL texts are not sent and meet nothing.
    """
    kept = [c for c in df.columns if c != text]
    keyed = df.where(F.col(text).isNotNull()).withColumn("_text_key", text_key(text))
    share = max(1, df.count() // HOT_SHARES)
    # counted by a short key: texts that share it are at most spread without need
    short = F.xxhash64("_text_key").alias("_short")
    hot = (
        keyed.select(short)
        .groupBy("_short")
        .agg(F.count("*").alias("_copies"))
        .where(F.col("_copies") > share)
        .select("_short", F.ceil(F.col("_copies") / share).cast("int").alias("_shares"))
    )
    is_hot = short == F.col("_short")
    spread = keyed.join(F.broadcast(hot), is_hot)
    rest = keyed.join(F.broadcast(hot), is_hot, "left_anti")

    def once(rows: DataFrame, how: str) -> DataFrame:
        """``_text_key, _answer`` and, of a model that was called now, ``_text``; ``how`` the rows
        are told from others by ``hot``."""
        if hasattr(model, "by_key"):
            return model.by_key(lambda noted: noted.join(F.broadcast(hot), is_hot, how))
        texts = rows.groupBy("_text_key").agg(F.first(text).alias("_text"))
        return model.add_answer(texts, "_text", fail_on_error)

    found = once(rest, "left_anti")
    if "_text" in found.columns:
        single = rest.drop(text).join(found.withColumnRenamed("_text", text), "_text_key", "left")
    else:
        single = rest.join(found, "_text_key", "left")
    # rows of one text follow one another in the count, so their shares take turns
    share_of_row = F.pmod(F.monotonically_increasing_id(), F.col("_shares")).cast("int")
    copies = spread.withColumn("_share", share_of_row)
    repeated = (
        once(spread, "left_semi")
        .join(F.broadcast(hot), is_hot)
        .select("_text_key", "_answer", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)).alias("_share"))
    )
    many = copies.join(repeated, ["_text_key", "_share"], "left")
    unsent = F.struct(
        F.lit(None).cast("string").alias("result"), F.lit(NULL_INPUT).alias("errorMessage")
    )
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(HOT_SHARES)).cast("int")
    nulls = df.where(F.col(text).isNull()).withColumns(
        {"_answer": unsent, "_text_key": F.lit(None).cast("binary"), "_share": turn}
    )
    single = single.withColumn("_share", F.lit(0))
    columns = [*kept, text, "_answer", "_text_key", "_share"]
    parts = [part.select(*columns) for part in (single, many, nulls)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def text_key(text: str):
    """SHA-256 of a text as bytes, half as long as its usual spelling."""
    return F.unhex(F.sha2(F.col(text), 256))


def register_model(spark: SparkSession, name: str, model: CallableModel) -> None:
    """Make a model callable from SQL: ``name(text, fail_on_error => false)`` gives
    ``struct<result, errorMessage>``."""
    spark.udf.register(name, model.udf())


def preview(df: DataFrame, order_by: str, n: int = 10) -> DataFrame:
    """First ``n`` documents by key, to be taken before a costly model is called."""
    return df.orderBy(order_by).limit(n)
