"""Tables: rebuild, describe, tag."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import PySparkException

from docpipe.functions.sqltext import identifier, quoted, string_literal
from docpipe.operators.keys import assert_new_keys
from docpipe.session import delete_path, list_folder
from docpipe.spec import DocumentSpec, type_text

log = logging.getLogger(__name__)

KEY_PROPERTY = "primary_key"
TAG_PREFIX = "tag."
#: Place of the build before the present one.
BEFORE_PROPERTY = "build.before"
_NEW, _ASIDE = "__new", "__aside"


def create_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {identifier(namespace)}")


def create_or_replace(
    df: DataFrame,
    table: str,
    column_comments: Mapping[str, str] | None = None,
    comment: str | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Full rebuild of ``table`` from ``df``; column comments travel in the schema, so they
    need no further statement.

    Every build is a folder of its own beside the others of the table. It is written whole and
    ``check`` looks at it, raising if it is not as it should be; then one statement points the
    table to it. Whatever fails before leaves the table as it was, what fails after leaves the
    new one. ``df`` may read the table that is rebuilt, and so may a query that is still running:
    the build before stays until the next but one.

    Comments and properties of the table, tags and the recorded key included, are kept, and
    ``column_comments`` and ``comment`` are put over them. A build with other columns needs two
    statements, since the catalog cannot change columns and place at once. If the second fails
    the first is taken back; if the driver itself is lost between them, :func:`recover` finishes
    the change, and so does the next rebuild.
    """
    spark = df.sparkSession
    described = with_comments(df, column_comments or {})
    recover(spark, table)
    known = spark.catalog.tableExists(table)
    place = _new_place(spark, table)
    described.write.parquet(place)
    if check is not None:
        check(_build(spark, described, place))
    if not known:
        _register(spark, described, table, place, {}, comment)
        return spark.table(table)
    old = _description(spark, table)
    described = with_comments(
        described, {c: t for c, t in old.comments.items() if c in df.columns and c not in (column_comments or {})}
    )
    properties = {**old.properties, BEFORE_PROPERTY: old.place}
    if _types(described) == _types(spark.table(table)):
        _run(spark, f"ALTER TABLE {identifier(table)} SET LOCATION {string_literal(place)}")
        document_table(spark, table, comment, _changed(described, old.comments))
        _set_properties(spark, table, {BEFORE_PROPERTY: old.place})
    else:
        new, aside = f"{table}{_NEW}", f"{table}{_ASIDE}"
        _register(spark, described, new, place, properties, old.comment if comment is None else comment)
        _run(spark, f"ALTER TABLE {identifier(table)} RENAME TO {identifier(aside)}")
        try:
            _run(spark, f"ALTER TABLE {identifier(new)} RENAME TO {identifier(table)}")
        except Exception:
            recover(spark, table, forward=False)
            raise
        _run(spark, f"DROP TABLE IF EXISTS {identifier(aside)}")
    if old.properties.get(BEFORE_PROPERTY):
        _delete(spark, old.properties[BEFORE_PROPERTY])
    spark.catalog.refreshTable(table)
    return spark.table(table)


def append(
    df: DataFrame,
    table: str,
    key: Sequence[str] | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Adds rows to ``table`` if they keep its key, by default the recorded one, and returns the
    table; otherwise raises :class:`~docpipe.operators.keys.ConstraintViolation` and leaves it as
    it was.

    The rows are written to a folder of their own first, so that what is checked is what is added,
    random ids included, and are read from there. Columns are taken by name; they must be those of
    the table. The table is read once, for its keys only (see
    :func:`~docpipe.operators.keys.clashing_keys`). One writer at a time: two appends that run
    together do not see each other's keys. ``df`` may read the table itself.
    """
    spark = df.sparkSession
    target = spark.table(table)
    if sorted(df.columns) != sorted(target.columns):
        raise ValueError(f"columns {sorted(df.columns)} are not those of {table}: {sorted(target.columns)}")
    rows = df.select(*map(quoted, target.columns))
    other = [(a, b) for a, b in zip(_types(rows), _types(target)) if a != b]
    if other:
        raise ValueError(f"types are not those of {table}: {other}")
    if key is None:
        noted = _description(spark, table).properties.get(KEY_PROPERTY)
        key = noted.split(",") if noted else []
    place = f"{_new_place(spark, table)}__rows"
    try:
        rows.write.parquet(place)
        staged = _build(spark, rows, place)
        if key:
            assert_new_keys(target, staged, key)
        if check is not None:
            check(staged)
        staged.write.insertInto(table)
    finally:
        _delete(spark, place)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def recover(spark: SparkSession, table: str, forward: bool = True) -> None:
    """Finishes, or takes back, a change of columns that was broken off. While such a change is
    under way the old table has another name for the time of one statement; what is whole under
    ``__new`` has been written and checked, so ``forward`` is right unless the catalog refuses."""
    new, aside = f"{table}{_NEW}", f"{table}{_ASIDE}"
    exists = spark.catalog.tableExists
    if not exists(table) and exists(aside):
        complete = forward and exists(new)
        source = new if complete else aside
        spark.sql(f"ALTER TABLE {identifier(source)} RENAME TO {identifier(table)}")
    for rest in (new, aside):
        if exists(table) and exists(rest):
            spark.sql(f"DROP TABLE IF EXISTS {identifier(rest)}")


def drop_builds(spark: SparkSession, table: str) -> int:
    """Deletes the folders of builds that the table refers to no longer, such as those of failed
    rebuilds, and gives their number. Not to be called while a rebuild is under way."""
    old = _description(spark, table)
    kept = {_base(p) for p in (old.place, old.properties.get(BEFORE_PROPERTY)) if p}
    unused = [p for p in list_folder(spark, _builds(spark, table)) if _base(p) not in kept]
    for path in unused:
        _delete(spark, path)
    return len(unused)


@dataclass(frozen=True)
class _Described:
    place: str
    comment: str | None
    comments: dict[str, str]
    properties: dict[str, str]


def _description(spark: SparkSession, table: str) -> _Described:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {identifier(table)}").collect()
    columns = set(spark.table(table).columns)
    details = {r.col_name: r.data_type for r in rows[len(columns) :]}
    noted = spark.sql(f"SHOW TBLPROPERTIES {identifier(table)}").collect()
    return _Described(
        details["Location"],
        details.get("Comment"),
        {r.col_name: r.comment for r in rows[: len(columns)] if r.comment},
        {r.key: r.value for r in noted if r.key == KEY_PROPERTY or r.key == BEFORE_PROPERTY or not _own(r.key)},
    )


def _own(key: str) -> bool:
    """Properties that the catalog writes itself."""
    return key.startswith(("spark.sql.", "transient_", "option.")) or key in ("comment", "owner", "provider", "location", "external")


def _types(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def _changed(df: DataFrame, before: Mapping[str, str]) -> dict[str, str]:
    now = {f.name: f.metadata["comment"] for f in df.schema if "comment" in f.metadata}
    return {name: text for name, text in now.items() if before.get(name) != text}


def _build(spark: SparkSession, df: DataFrame, place: str) -> DataFrame:
    return spark.read.schema(df.schema).parquet(place)


def _register(spark, df, table, place, properties, comment) -> None:
    """A table over a finished build, in one statement."""
    columns = ", ".join(
        f"{quoted(f.name)} {type_text(f.dataType)}"
        + (f" COMMENT {string_literal(f.metadata['comment'])}" if "comment" in f.metadata else "")
        for f in df.schema
    )
    noted = ", ".join(f"{string_literal(k)} = {string_literal(v)}" for k, v in properties.items())
    _run(
        spark,
        f"CREATE TABLE {identifier(table)} ({columns}) USING parquet"
        + (f" COMMENT {string_literal(comment)}" if comment is not None else "")
        + f" LOCATION {string_literal(place)}"
        + (f" TBLPROPERTIES ({noted})" if noted else ""),
    )


def _builds(spark: SparkSession, table: str) -> str:
    """Folder of all builds of a table, in the folder of its namespace."""
    *namespace, name = table.replace("`", "").split(".")
    database = spark.catalog.getDatabase(".".join(namespace) or spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{name}__builds"


def _new_place(spark: SparkSession, table: str) -> str:
    return f"{_builds(spark, table)}/{uuid.uuid4().hex}"


def _base(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def _delete(spark: SparkSession, path: str) -> None:
    """A build that no table refers to. One that cannot be deleted costs space, nothing else."""
    try:
        delete_path(spark, path)
    except Exception as problem:  # noqa: BLE001 - the rebuild itself has succeeded
        log.warning("%s could not be deleted: %s", path, problem)


def _run(spark: SparkSession, statement: str) -> None:
    """Every statement that changes the catalog in a rebuild."""
    spark.sql(statement)


def with_comments(df: DataFrame, column_comments: Mapping[str, str]) -> DataFrame:
    """``df`` with comments in the column metadata; Parquet files keep them as well."""
    missing = set(column_comments) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    for name, text in column_comments.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "comment": text})
    return df


def output_comments(spec: DocumentSpec) -> dict[str, str]:
    comments = {"id": spec.id_comment} if spec.id_comment else {}
    return comments | {o.column: o.comment for o in spec.outputs if o.comment}


def comment_table(spark: SparkSession, table: str, comment: str) -> None:
    _run(spark, f"COMMENT ON TABLE {identifier(table)} IS {string_literal(comment)}")


def document_table(
    spark: SparkSession, table: str, comment: str | None, column_comments: Mapping[str, str]
) -> None:
    """Comments on an existing table, unless NULL, and its columns."""
    if comment is not None:
        comment_table(spark, table, comment)
    for name, text in column_comments.items():
        _run(
            spark,
            f"ALTER TABLE {identifier(table)} ALTER COLUMN {quoted(name)} "
            f"COMMENT {string_literal(text)}",
        )


def record_key(spark: SparkSession, table: str, columns: Sequence[str]) -> None:
    """Note the (checked) key in the table properties; doing it again replaces the note."""
    _set_properties(spark, table, {KEY_PROPERTY: ",".join(columns)})


def tag_table(spark: SparkSession, table: str, tag: str) -> bool:
    """Mark a table. A catalog that refuses is reported and does not stop the job."""
    try:
        _set_properties(spark, table, {TAG_PREFIX + tag: "true"})
    except PySparkException as problem:
        log.warning("tag %s could not be set on %s: %s", tag, table, problem)
        return False
    return True


def _set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    noted = ", ".join(f"{string_literal(k)} = {string_literal(v)}" for k, v in properties.items())
    _run(spark, f"ALTER TABLE {identifier(table)} SET TBLPROPERTIES ({noted})")


def dictionary(df: DataFrame) -> DataFrame:
    """What is in a table: one row per column with position, type, comment, number of rows
    and of NULLs. Counting is one aggregation over the table."""
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(F.col(quoted(f.name))).alias(f"_n{i}") for i, f in enumerate(df.schema)],
    )
    listed = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.metadata.get("comment")).cast("string").alias("comment"),
                F.col("_rows").alias("n_rows"),
                (F.col("_rows") - F.col(f"_n{i}")).alias("n_nulls"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return counted.select(F.inline(listed))
