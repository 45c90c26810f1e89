import pytest
from conftest import optimized, plan_of
from pyspark.sql import functions as F
from samples import LINES, golden

from docpipe.functions.sqltext import identifier, string_literal
from docpipe.operators import keys, tables
from docpipe.operators.extract import CallableModel
from docpipe.operators.tables import (
    KEY_PROPERTY,
    append,
    create_namespace,
    create_or_replace,
    dictionary,
    document_table,
    drop_builds,
    output_comments,
    record_key,
    recover,
    tag_table,
)
from docpipe.plans.receipts import COLUMN_COMMENTS, RECEIPT
from docpipe.plans.stages import build_tables
from docpipe.session import list_folder


@pytest.fixture(scope="module")
def space(spark):
    create_namespace(spark, "papers")
    create_namespace(spark, "papers")
    return "papers"


def column_comments(spark, table):
    return {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {table}").collect()}


def properties(spark, table):
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def test_rebuild_replaces(spark, space):
    create_or_replace(spark.range(3), f"{space}.numbers")
    again = create_or_replace(spark.range(2).selectExpr("id AS other"), f"{space}.numbers")
    assert again.columns == ["other"] and again.count() == 2


def test_rebuild_from_itself(spark, space):
    t = create_or_replace(spark.range(3), f"{space}.self")
    assert create_or_replace(t.where("id > 0"), f"{space}.self").count() == 2


def test_a_failed_rebuild_keeps_the_old_table(spark, space):
    create_or_replace(spark.range(3), f"{space}.kept", comment="first")
    before = {t.name for t in spark.catalog.listTables(space)}
    bad = spark.range(3).selectExpr("raise_error('no') AS id")
    with pytest.raises(Exception, match="no"):
        create_or_replace(bad, f"{space}.kept")
    repeated = spark.range(4).selectExpr("id % 2 AS id")
    with pytest.raises(keys.ConstraintViolation):
        create_or_replace(repeated, f"{space}.kept", check=lambda t: keys.assert_primary_key(t, ["id"]))
    assert spark.table(f"{space}.kept").count() == 3
    assert {t.name for t in spark.catalog.listTables(space)} == before


def test_keys_with_odd_names(spark):
    df = spark.createDataFrame([(1, 2), (1, 2)], "`odd.name` int, `a b` int")
    assert [tuple(r) for r in keys.duplicate_keys(df, ["odd.name", "a b"]).collect()] == [(1, 2, 2)]
    assert keys.null_counts(df, ["odd.name"]).head().n_nulls == 0


def test_variant_column_survives(spark, space, records):
    t = create_or_replace(records(golden(), "{bad"), f"{space}.records")
    assert dict(t.dtypes)["response"] == "variant"
    assert t.where("response IS NULL").count() == 1


@pytest.mark.parametrize("text", ["it's", 'say "x"', "back\\slash", "line\nbreak", "発行日", "\\'"])
def test_text_in_statements(spark, space, text):
    assert spark.sql(f"SELECT {string_literal(text)} AS x").head().x == text
    create_or_replace(spark.range(1), f"{space}.noted")
    document_table(spark, f"{space}.noted", text, {"id": text})
    assert column_comments(spark, f"{space}.noted")["id"] == text


def test_identifiers(spark):
    assert identifier("a.b") == "`a`.`b`"
    assert identifier("`a`.b`c") == "`a`.`b``c`"


def test_comments_need_no_further_statement(spark, space):
    df = spark.range(1).selectExpr("id", "'x' AS name")
    create_or_replace(df, f"{space}.described", {"name": "what it's called"}, "a table")
    assert column_comments(spark, f"{space}.described")["name"] == "what it's called"
    with pytest.raises(ValueError):
        create_or_replace(df, f"{space}.described", {"nothing": "x"})


def test_tag_is_reported_when_refused(spark, space, caplog):
    create_or_replace(spark.range(1), f"{space}.tagged")
    assert tag_table(spark, f"{space}.tagged", "certified")
    assert properties(spark, f"{space}.tagged")["tag.certified"] == "true"
    assert not tag_table(spark, f"{space}.nowhere", "certified")
    assert "certified" in caplog.text


def test_dictionary(spark):
    df = spark.range(4).select(
        "id", F.when(F.col("id") > 0, F.lit("x")).alias("odd.name", metadata={"comment": "c"})
    )
    rows = [tuple(r) for r in dictionary(df).collect()]
    assert rows == [(1, "id", "bigint", None, 4, 0), (2, "odd.name", "string", "c", 4, 1)]


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None)], "k int, s string")
    assert [tuple(r) for r in keys.duplicate_keys(df, ["k", "s"]).collect()] == [(1, "a", 2)]
    counts = {r.column_name: (r.n_rows, r.n_nulls) for r in keys.null_counts(df, ["k", "s"]).collect()}
    assert counts == {"k": (4, 0), "s": (4, 1)}
    keys.assert_not_null(df, ["k"])
    with pytest.raises(keys.ConstraintViolation, match="s: 1"):
        keys.assert_not_null(df, ["k", "s"])
    with pytest.raises(keys.ConstraintViolation, match="not unique"):
        keys.assert_primary_key(df, ["k"])
    keys.assert_primary_key(spark.range(5), ["id"])


def echo():
    return lambda texts: list(texts)


def test_whole_way(spark):
    """Texts that are already JSON, through a model that repeats them."""
    texts = spark.createDataFrame(
        [("1", golden()), ("2", golden(details=[])), ("3", "{bad")], "doc_id string, text string"
    )
    for identifier_kind in ("stable", "uuid"):
        gold = build_tables(
            texts, RECEIPT, CallableModel(echo), "paperwork", "receipt", "flat receipts",
            "certified", {"identifier": identifier_kind},
        )
        assert gold.columns == list(COLUMN_COMMENTS)
        assert gold.count() == len(LINES)
        assert sorted(r.id for r in gold.collect()) == sorted(r.id for r in gold.collect())
    assert spark.table("paperwork.receipt_bronze").count() == 3
    assert spark.table("paperwork.receipt_silver").where("error = 'MALFORMED_JSON'").count() == 1
    assert column_comments(spark, "paperwork.receipt_gold") == output_comments(RECEIPT)
    noted = properties(spark, "paperwork.receipt_gold")
    assert noted[KEY_PROPERTY] == "id" and noted["tag.certified"] == "true"
    assert {r.column_name: r.comment for r in dictionary(gold).collect()} == COLUMN_COMMENTS
    keys.assert_primary_key(gold, ["id"])


def test_repeated_documents_are_refused_before_the_model(spark):
    texts = spark.createDataFrame([("1", "{}"), ("1", "{}")], "doc_id string, text string")
    with pytest.raises(keys.ConstraintViolation, match="not unique"):
        build_tables(texts, RECEIPT, CallableModel(echo), "paperwork", "twice")
    assert not spark.catalog.tableExists("paperwork.twice_silver")


class Lost(Exception):
    """A fault put in front of a statement."""


def rebuilds(spark, space, name, second, monkeypatch, lost_driver):
    """A first build, then the second one with a fault before its n-th statement, for all n."""
    run, statements = tables._run, []
    for n in range(30):
        monkeypatch.setattr(tables, "_run", run)
        table = f"{space}.{name}_{n}"
        create_or_replace(spark.range(3).selectExpr("id", "'old' AS x"), table, {"x": "an old comment"}, "old")
        tag_table(spark, table, "kept")
        record_key(spark, table, ["id"])
        done = []

        def failing(session, statement):
            if len(done) == n:
                raise Lost(statement)
            done.append(statement)
            run(session, statement)

        monkeypatch.setattr(tables, "_run", failing)
        if lost_driver:  # nothing can be taken back
            monkeypatch.setattr(tables, "recover", lambda *a, **k: None)
        try:
            create_or_replace(second(spark), table, {"x": "new"}, "new")
        except Lost:
            statements.append(done)
        else:
            monkeypatch.undo()
            yield table, True
            return
        finally:
            monkeypatch.undo()
        yield table, False


SAME = lambda spark: spark.range(5).selectExpr("id", "'new' AS x")
OTHER = lambda spark: spark.range(5).selectExpr("id", "'new' AS x", "id * 2 AS more")


@pytest.mark.parametrize("second", [SAME, OTHER], ids=["same columns", "other columns"])
def test_a_fault_before_any_statement_leaves_a_whole_table(spark, space, monkeypatch, second):
    name = "fault_same" if second is SAME else "fault_other"
    seen = []
    for table, whole in rebuilds(spark, space, name, second, monkeypatch, lost_driver=False):
        found = {(r.x, r.n) for r in spark.sql(f"SELECT x, count(*) AS n FROM {table} GROUP BY x").collect()}
        assert found in ({("old", 3)}, {("new", 5)})
        seen.append(found)
        # and the next rebuild succeeds
        assert create_or_replace(second(spark), table, {"x": "new"}, "new").count() == 5
        assert properties(spark, table)["tag.kept"] == "true" and properties(spark, table)[KEY_PROPERTY] == "id"
        assert column_comments(spark, table)["x"] == "new"
    assert {("old", 3)} in seen and seen[-1] == {("new", 5)}


def test_a_driver_lost_between_two_statements(spark, space, monkeypatch):
    for table, _ in rebuilds(spark, space, "lost", OTHER, monkeypatch, lost_driver=True):
        recover(spark, table)
        assert spark.table(table).count() in (3, 5)
        rest = {t.name for t in spark.catalog.listTables(space) if t.name.startswith(table.split(".")[1] + "__")}
        assert not rest


def test_descriptions_survive_a_rebuild(spark, space):
    table = f"{space}.carried"
    for other in (False, True):
        create_or_replace(spark.range(2).selectExpr("id", "1 AS n"), table, {"id": "the id"}, "what it is")
        tag_table(spark, table, "certified")
        record_key(spark, table, ["id"])
        again = spark.range(4).selectExpr("id", "'x' AS n" if other else "2 AS n")
        create_or_replace(again, table)
        assert column_comments(spark, table)["id"] == "the id"
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
        assert described["Comment"] == "what it is"
        noted = properties(spark, table)
        assert noted["tag.certified"] == "true" and noted[KEY_PROPERTY] == "id"


def test_a_running_reader_keeps_its_build(spark, space):
    reader = create_or_replace(spark.range(3), f"{space}.read")
    create_or_replace(spark.range(7), f"{space}.read")
    assert reader.count() == 3 and spark.table(f"{space}.read").count() == 7
    create_or_replace(spark.range(9), f"{space}.read")
    folder = tables._builds(spark, f"{space}.read")
    assert len(list_folder(spark, folder)) == 2  # the one before the last is gone
    with pytest.raises(Exception, match="no"):
        create_or_replace(spark.range(3).selectExpr("raise_error('no') AS id"), f"{space}.read")
    assert drop_builds(spark, f"{space}.read") == 1 and spark.table(f"{space}.read").count() == 9


def test_append_keeps_the_key(spark, space):
    name = f"{space}.appended"
    first = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id bigint, part string, x double")
    create_or_replace(first, name)
    record_key(spark, name, ["id", "part"])
    rows = lambda: sorted(map(tuple, spark.table(name).collect()))
    before = rows()
    clash, repeated = [(3, "c", 0.0), (2, "b", 9.0)], [(3, "c", 0.0), (3, "c", 1.0)]
    for bad, problem in ((clash, "already there"), (repeated, "not unique"), ([(None, "c", 0.0)], "NULL")):
        with pytest.raises(keys.ConstraintViolation, match=problem):
            append(spark.createDataFrame(bad, first.schema), name)
        assert rows() == before
    # by name, whatever the order; a key of two columns clashes only as a whole
    more = spark.createDataFrame([(5.0, 2, "a"), (6.0, 1, "b")], "x double, id bigint, part string")
    append(more, name)
    assert rows() == sorted([*before, (2, "a", 5.0), (1, "b", 6.0)])
    assert append(first.where("false"), name).count() == 4
    # rows of the table itself
    append(spark.table(name).withColumn("id", F.col("id") + 10), name)
    assert spark.table(name).count() == 8
    assert properties(spark, name)[KEY_PROPERTY] == "id,part"
    assert drop_builds(spark, name) == 0


def test_append_of_other_columns_or_refused_rows(spark, space):
    name = f"{space}.appended_too"
    create_or_replace(spark.range(3).withColumn("t", F.lit("x")), name)
    with pytest.raises(ValueError, match="columns"):
        append(spark.range(3), name)
    with pytest.raises(ValueError, match="types"):
        append(spark.range(3).withColumn("t", F.lit(1)), name)

    def refuse(rows):
        raise keys.ConstraintViolation(f"{rows.count()} rows")

    with pytest.raises(keys.ConstraintViolation, match="^2 rows$"):
        append(spark.range(2).withColumn("t", F.lit("x")), name, check=refuse)
    assert spark.table(name).count() == 3
    # no key: rows may repeat; random values are added as they were checked
    seen = []
    append(
        spark.range(2).withColumn("t", F.uuid()), name, check=lambda rows: seen.extend(r.t for r in rows.collect())
    )
    assert sorted(r.t for r in spark.table(name).where("t <> 'x'").collect()) == sorted(seen)


def test_clashing_keys_against_brute_force(spark):
    columns = "a bigint, b string, d double"
    old = [(i % 700, str(i % 3), float(i % 5)) for i in range(3000)] + [(None, "0", 0.0), (1, "hot", 0.0)] + [(7, "hot", 0.0)] * 500
    new = [(i, "1", float(i % 5)) for i in range(600, 800)] + [(None, "0", 0.0), (7, "hot", -0.0), (8, "hot", 0.0)]
    expected = sorted({n for n in new if None not in n} & set(old))
    existing, added = spark.createDataFrame(old, columns), spark.createDataFrame(new, columns)
    found = keys.clashing_keys(existing, added, ["a", "b", "d"])
    assert sorted(map(tuple, found.collect())) == expected and len(expected) > 20
    assert keys.clashing_keys(existing, added.where("false"), ["a"]).collect() == []
    assert keys.clashing_keys(existing.where("false"), added, ["a"]).collect() == []


def test_only_rows_that_may_clash_are_moved(spark, tmp_path):
    path = str(tmp_path / "existing")
    spark.range(200_000).write.parquet(path)
    existing, added = spark.read.parquet(path), spark.range(199_990, 200_100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = keys.clashing_keys(existing, added, ["id"])
        assert "BroadcastHashJoin" in plan_of(found) and "SortMergeJoin" in plan_of(found)
        assert sorted(r.id for r in found.collect()) == list(range(199_990, 200_000))
        # rows of the aggregate below the exact join: what passed the bits
        semi = found._jdf.queryExecution().optimizedPlan().children().head()
        passed = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, semi).count()
        assert passed < 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "rand" in optimized(found)
