"""Receipts: their specification, and a corpus of receipt texts printed from order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docpipe.spec import DocumentSpec, Field, Output, PartsTotal, Product, SumOf

ISO_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
ZIP_CODE = "^[0-9]{3}-[0-9]{4}$"

# Column comments of the flat receipt table. They have to read as given.
COLUMN_COMMENTS = {
    "id": "自動採番したユニークID",
    "issue_date": "発行日",
    "billing_name": "請求先名",
    "supplier_zip": "請求元 郵便番号",
    "supplier_address": "請求元 住所",
    "supplier_company": "請求元 企業名",
    "supplier_department": "請求元 部署名",
    "item_name": "明細 商品名",
    "item_qty": "明細 数量",
    "item_unit_price": "明細 単価",
    "item_amount": "明細 金額",
    "subtotal": "小計（税抜）",
    "consumption_tax": "消費税金額",
    "total_amount_with_tax": "合計金額（税込）",
    "remarks": "備考",
}

RECEIPT = DocumentSpec(
    name="receipt",
    row_label="ITEM",
    id_comment=COLUMN_COMMENTS["id"],
    fields=(
        Field("issue_date", label="Issue date", nullable=False, pattern=ISO_DATE,
              date_format="yyyy-MM-dd", description="Day the receipt was issued."),
        Field("billing_name", label="Billed to", nullable=False,
              description="Person or company the receipt is made out to."),
        Field("supplier", kind="object", label="Supplier", description="Who issued the receipt.",
              fields=(
                  Field("zip_code", label="Supplier zip", pattern=ZIP_CODE,
                        description="Postal code, three and four digits."),
                  Field("address", label="Supplier address", description="Full address."),
                  Field("company_name", label="Supplier company", nullable=False,
                        description="Registered company name."),
                  Field("department_name", label="Supplier department",
                        description="Department in charge."),
              )),
        Field("details", kind="array", description="Line items in printed order.",
              fields=(
                  Field("item_name", description="Product or service."),
                  Field("item_quantity", kind="integer", description="Quantity, no separators."),
                  Field("item_unit_price", kind="integer", description="Price of one unit."),
                  Field("item_amount", kind="integer", description="Quantity times unit price."),
              )),
        Field("subtotal", kind="integer", label="Subtotal",
              description="Sum of the line amounts before tax."),
        Field("consumption_tax", kind="integer", label="Tax", nullable=False,
              description="Tax on the subtotal."),
        Field("total_amount", kind="integer", label="Total", nullable=False,
              description="Subtotal and tax."),
        Field("remarks", label="Remarks", description="Notes."),
    ),
    outputs=tuple(
        Output(column, path, kind, COLUMN_COMMENTS[column])
        for column, path, kind in (
            ("issue_date", "issue_date", "string"),
            ("billing_name", "billing_name", "string"),
            ("supplier_zip", "supplier.zip_code", "string"),
            ("supplier_address", "supplier.address", "string"),
            ("supplier_company", "supplier.company_name", "string"),
            ("supplier_department", "supplier.department_name", "string"),
            ("item_name", "details[].item_name", "string"),
            ("item_qty", "details[].item_quantity", "bigint"),
            ("item_unit_price", "details[].item_unit_price", "bigint"),
            ("item_amount", "details[].item_amount", "bigint"),
            ("subtotal", "subtotal", "bigint"),
            ("consumption_tax", "consumption_tax", "bigint"),
            ("total_amount_with_tax", "total_amount", "bigint"),
            ("remarks", "remarks", "string"),
        )
    ),
    arithmetic=(
        Product("line_amount", "details", "item_amount", ("item_quantity", "item_unit_price")),
        SumOf("subtotal", "subtotal", "details", "item_amount"),
        PartsTotal("total", "total_amount", ("subtotal", "consumption_tax")),
    ),
)

# Lines whose numbers fall into one block of this size are printed on one receipt.
LINES_PER_RECEIPT = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def receipt_texts(
    orders: DataFrame,
    lineitem: DataFrame,
    customer: DataFrame,
    supplier: DataFrame,
    part: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    lines_per_receipt: int = LINES_PER_RECEIPT,
) -> DataFrame:
    """``(doc_id, text)``: every order as printed receipts, with some defects (see ``_text``).

    The sheet of a line is ``(line number - 1) div lines_per_receipt``, whatever the size of the
    order. Sheet 0 is named by the order key, others ``<key>/<sheet>``; each has its own sums.
    Fully equal lines are printed once, their quantities added up; that is summed before lines
    are shuffled, so repeated rows of a huge order do not travel.
    """
    sheet = F.expr(f"(greatest(l_linenumber, 1) - 1) div {int(lines_per_receipt)}")
    merged = lineitem.groupBy(
        "l_orderkey", sheet.alias("sheet"), "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("bigint").alias("each"),
    ).agg((F.col("each") * F.count("*")).alias("quantity"))
    billed = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "c_name"
    )
    return _printed(billed, _gathered(_priced(merged, part)), supplier, nation, region)


def _priced(lines: DataFrame, part: DataFrame) -> DataFrame:
    """Lines with product name and amounts in cents."""
    unit = F.round(F.col("p_retailprice") * 100).cast("bigint")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        "l_orderkey", "sheet", "l_linenumber", "l_partkey", "l_suppkey",
        F.translate("p_name", "\n\t\r", "   ").alias("name"),
        "quantity",
        unit.alias("unit"),
        (F.col("quantity") * unit).alias("amount"),
    )


def _gathered(lines: DataFrame) -> DataFrame:
    """Lines of one receipt, in an order that does not depend on the storage. Lists do not get
    smaller by combining them early, so the lines are brought together first, by what the orders
    are joined on: the lists themselves are then not moved. A receipt is a group of its own."""
    return (
        lines.repartition("l_orderkey")
        .groupBy("l_orderkey", "sheet")
        .agg(
            F.min("l_suppkey").alias("seller"),
            F.sum("amount").alias("subtotal"),
            F.array_sort(
                F.collect_list(
                    F.struct("l_linenumber", "l_partkey", "l_suppkey", "quantity", "unit",
                             "amount", "name")
                )
            ).alias("items"),
        )
    )


def _printed(billed: DataFrame, gathered: DataFrame, supplier, nation, region) -> DataFrame:
    receipts = (
        billed.join(gathered, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(supplier, F.col("seller") == F.col("s_suppkey"), "left")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    key = F.col("o_orderkey").cast("string")
    doc_id = F.when(F.col("sheet") > 0, F.concat_ws("/", key, "sheet")).otherwise(key)
    return receipts.select(doc_id.alias("doc_id"), _text(F.col("o_orderkey")).alias("text"))


def _line(label: str, value: Column) -> Column:
    printed = F.when(value == "", F.lit('""')).otherwise(
        F.translate(value.cast("string"), "\n\r", "  ")
    )
    return F.concat(F.lit(f"{label}:"), F.coalesce(F.concat(F.lit(" "), printed), F.lit("")))


def _text(k: Column) -> Column:
    """The printed receipt. Defects depend on the order key, so that what a check should find
    can be told from the order tables alone."""
    has_lines = F.col("items").isNotNull()
    subtotal = F.coalesce(F.col("subtotal"), F.lit(0))
    tax = F.floor(subtotal / 10).cast("bigint")
    total = subtotal + tax + F.when(k % 83 == 2, 1).otherwise(0)
    code = F.concat(
        F.lpad(F.col("s_nationkey").cast("string"), 3, "0"),
        F.when(k % 73 == 4, F.lit("")).otherwise(F.lit("-")),
        F.lpad((F.col("s_suppkey") % 10000).cast("string"), 4, "0"),
    )
    seller_lines = F.concat_ws(
        "\n",
        F.when(k % 71 != 5, _line("Supplier zip", code)),
        _line("Supplier address", F.concat_ws(", ", "n_name", "r_name")),
        _line("Supplier company", F.when(k % 61 == 7, F.lit("")).otherwise(F.col("s_name"))),
        _line("Supplier department", F.lit(None).cast("string")),
    )

    def item(row: Column, i: Column) -> Column:
        wrong = F.when((k % 67 == 6) & (i == 0), 1).otherwise(0)
        cells = (i, row["name"], row["quantity"], row["unit"], row["amount"] + wrong)
        return F.concat_ws(
            "\t", F.lit("ITEM"), *[F.coalesce(c.cast("string"), F.lit("")) for c in cells]
        )

    date_pattern = [F.date_format("o_orderdate", p) for p in ("yyyy/MM/dd", "yyyy-MM-dd")]
    readable = F.concat_ws(
        "\n",
        _line("Issue date", F.when(k % 79 == 3, date_pattern[0]).otherwise(date_pattern[1])),
        _line("Billed to", F.col("c_name")),
        F.when(has_lines, seller_lines).otherwise(F.lit("Supplier:")),
        F.transform(F.col("items"), item),
        _line(
            "Subtotal",
            F.when(has_lines & (k % 89 == 1), F.format_number(subtotal, 0)).otherwise(
                subtotal.cast("string")
            ),
        ),
        _line("Tax", tax.cast("string")),
        _line("Total", total.cast("string")),
        _line("Remarks", F.col("o_orderpriority")),
    )
    return F.when(k % 97 == 0, F.concat(F.lit("unreadable scan "), k.cast("string"))).otherwise(
        readable
    )
