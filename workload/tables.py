"""The test tables in the shapes the operators expect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citeweave.functions.text import url_quote
from citeweave.operators.identity import dense_position
from citeweave.schemas import CITATION, PAPERS, REFERENCE
from citeweave.staging import Staging


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its schema is looked up in the file once."""
    path = f"{sf}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _key(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def part_papers(spark: SparkSession, sf: str) -> DataFrame:
    """``g_papers``: parts as seed papers, brands as search terms."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        _key("P", "p_partkey").alias("ss_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("abstract"),
        F.col("p_brand").alias("search_term"),
        F.lit(0).alias("num_hops"),
        _key("/part/", "p_partkey").alias("url"),
        (F.col("p_size") % 2 == 0).alias("is_processed"),
    )


def raw_edges(spark: SparkSession, sf: str) -> DataFrame:
    """One edge per line item, repeats included: the order cites the part."""
    return table(spark, sf, "lineitem").select(
        _key("O", "l_orderkey").alias("ss_id"),
        _key("P", "l_partkey").alias("reference_id"),
        "l_returnflag",
        "l_linestatus",
    )


def part_edges(spark: SparkSession, sf: str) -> DataFrame:
    """``g_edges``: the distinct edges."""
    return raw_edges(spark, sf).select("ss_id", "reference_id").distinct()


def document_papers(spark: SparkSession, sf: str) -> DataFrame:
    """``d_papers``: documents as papers, sources as search terms; unlabelled ones have no flag."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return table(spark, sf, "documents").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        _key("D", "doc_id").alias("ss_id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("abstract"),
        F.col("source").alias("search_term"),
        F.lit(0).alias("num_hops"),
        _key("/doc/", "doc_id").alias("url"),
        (F.col("quality") == 1).alias("is_processed"),
        "lang",
    )


def order_papers(spark: SparkSession, sf: str) -> DataFrame:
    """``o_papers``: orders as papers, priorities as search terms."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        _key("O", "o_orderkey").alias("ss_id"),
        F.concat(F.lit("Order "), "o_orderpriority").alias("title"),
        F.concat(F.lit("Status "), "o_orderstatus").alias("abstract"),
        F.col("o_orderpriority").alias("search_term"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("num_hops"),
        _key("/order/", "o_orderkey").alias("url"),
        (F.col("o_orderstatus") == "F").alias("is_processed"),
        "o_orderstatus",
    )


def ranked_terms(spark: SparkSession, sf: str, name: str, column: str, staging: Staging) -> DataFrame:
    """The distinct values of a column as a term list in alphabetical order."""
    values = table(spark, sf, name).select(F.col(column).alias("term")).distinct()
    return dense_position(values, ["term"], staging, column="term_pos")


def part_terms(spark: SparkSession, sf: str, staging: Staging) -> DataFrame:
    return ranked_terms(spark, sf, "part", "p_brand", staging)


def document_terms(spark: SparkSession, sf: str, staging: Staging) -> DataFrame:
    return ranked_terms(spark, sf, "documents", "source", staging)


def order_terms(spark: SparkSession, sf: str, staging: Staging) -> DataFrame:
    return ranked_terms(spark, sf, "orders", "o_orderpriority", staging)


def no_papers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PAPERS)


PAGE_KEYS = 10_000  # order keys per page of a look-up, so no page grows with the data


def _supplied(spark: SparkSession, sf: str) -> DataFrame:
    """The suppliers of the parts of one type, page by page, as the papers that those parts cite."""
    key = F.col("s_suppkey").cast("string")
    item = F.concat(
        F.lit('{"citedPaper":{"paperId":"S'), key, F.lit('","title":"'), "s_name", F.lit('","url":"/supplier/'), key, F.lit('"}}')
    )
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")).distinct()
    economy = table(spark, sf, "part").filter("p_type = 'ECONOMY'").select("p_partkey")
    return (
        lines.join(economy, "p_partkey", "left_semi")
        .join(table(spark, sf, "supplier").select("s_suppkey", "s_name"), "s_suppkey")
        .select("p_partkey", F.floor(F.col("s_suppkey") / PAGE_KEYS).cast("int").alias("page"), F.struct("s_suppkey", item.alias("item")).alias("row"))
        .groupBy("p_partkey", "page")
        .agg(F.sort_array(F.collect_list("row")).alias("rows"))
        .select("p_partkey", "page", F.concat(F.lit('{"data":['), F.array_join("rows.item", ","), F.lit("]}")).alias("cited"))
    )


def _citing(order: Column) -> Column:
    """The item that names an order as a citing paper."""
    status, priority, key = order["o_orderstatus"], order["o_orderpriority"], order["o_orderkey"].cast("string")
    title = (
        F.when(status == "P", F.lit(',"title":null'))
        .when(status == "F", F.lit(""))
        .otherwise(F.concat(F.lit(',"title":"Order '), priority, F.lit('"')))
    )
    abstract = (
        F.when(priority == "1-URGENT", F.lit(',"abstract":null'))
        .when(priority == "5-LOW", F.lit(',"abstract":""'))
        .when(priority == "2-HIGH", F.lit(""))
        .otherwise(F.concat(F.lit(',"abstract":"Priority '), priority, F.lit('"')))
    )
    return F.concat(
        F.lit('{"citingPaper":{"paperId":"O'), key, F.lit('"'), title, abstract,
        F.lit(',"url":"/order/'), key, F.lit('"}}'),
    )


def landed_responses(spark: SparkSession, sf: str, parts: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Look-ups of all parts as they would have landed.

    Citations carry the orders of a part, page by page, with every shape of absent, null and
    empty fields that order attributes select; references carry the suppliers of parts of one type,
    and nothing for the others, which differ in how they say so. ``parts`` are the parts to look up, all if left out, and
    ``carry`` names columns of them to keep.

    Keys and attributes of orders are brought together; bodies are written where the rows have come to lie, and not moved.
    """
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").distinct()
    parts = table(spark, sf, "part") if parts is None else parts
    parts = parts.select("p_partkey", "p_type", *carry)
    cited = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_partkey", F.floor(F.col("o_orderkey") / PAGE_KEYS).cast("int").alias("page"), F.struct(*orders.columns).alias("order"))
        .groupBy("l_partkey", "page")
        .agg(F.collect_list("order").alias("orders"))
    )
    items = F.sort_array(F.transform("orders", lambda order: F.struct(order["o_orderkey"], _citing(order).alias("item"))))
    citations = cited.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_partkey").alias("id"),
        _key("P", "p_partkey").alias("ss_id"),
        F.lit(CITATION).alias("direction"),
        "page",
        F.lit(200).alias("status"),
        # Some sources send the bare list, the others an object around it.
        F.concat(
            F.when(F.col("p_type") == "ECONOMY", "[").otherwise('{"data":['),
            F.array_join(items["item"], ","),
            F.when(F.col("p_type") == "ECONOMY", "]").otherwise("]}"),
        ).alias("body"),
        *carry,
    )
    references = parts.join(_supplied(spark, sf), "p_partkey", "left").select(
        F.col("p_partkey").alias("id"),
        _key("P", "p_partkey").alias("ss_id"),
        F.lit(REFERENCE).alias("direction"),
        F.coalesce("page", F.lit(0)).alias("page"),
        F.when(F.col("p_type") == "STANDARD", 404).otherwise(200).alias("status"),
        F.when(F.col("p_type") == "PROMO", "{}")
        .when(F.col("p_type") == "SMALL", '{"data":null}')
        .when(F.col("p_type") == "MEDIUM", "{bad")
        .when(F.col("p_type") == "LARGE", '{"data":[{},{"citedPaper":null},{"citedPaper":{"paperId":"","title":"x"}},7]}')
        .otherwise(F.coalesce("cited", F.lit("[]")))
        .alias("body"),
        *carry,
    )
    return citations.unionByName(references)


def _escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


RESULTS_PER_PAGE = 10


def result_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as pages of search results, ten ids to a page.

    English abstracts stand in a block before the button, Spanish ones are not expanded, the
    others stand around the button under a heading. The footer has such a button too, which belongs to no result.
    """
    docs = table(spark, sf, "documents")
    key = _key("D", "doc_id")
    body = F.concat(F.lit("<span>"), _escaped(F.col("text")), F.lit("</span>"))
    button = '<button class="cl-button more-toggle"><span class="cl-button__label">{}</span></button>'
    shown = (
        F.when(F.col("lang") == "en", F.concat(F.lit('<div class="tldr">'), body, F.lit("</div>" + button.format("Collapse"))))
        .when(F.col("lang") == "es", F.lit(button.format("Expand")))
        .otherwise(
            F.concat(
                F.lit('<div class="abstract"><span>Abstract</span><!-- text --><br>'), body,
                F.lit(button.format("Collapse") + "</div>"),
            )
        )
    )
    # Some titles have an id that cannot be read.
    ident = F.when(F.col("n_chars") % 11 == 0, F.lit("paper")).otherwise(F.concat(F.lit("paper-"), key))
    row = F.concat(
        F.lit('<div class="result cl-paper-row"><h2 class="cl-paper-title" id="'), ident, F.lit('"><span>'),
        _escaped(F.split_part("text", F.lit("\n"), F.lit(1))), F.lit(" </span></h2><div>"), shown, F.lit("</div></div>\n"),
    )
    rows = docs.select(
        "source", F.floor(F.col("doc_id") / RESULTS_PER_PAGE).alias("page"), F.struct("doc_id", row.alias("row")).alias("row")
    )
    return (
        rows.groupBy("source", "page")
        .agg(F.sort_array(F.collect_list("row")).alias("rows"))
        .select(
            url_quote(F.col("source")).alias("term"),
            "page",
            F.concat(
                F.lit('<html><head><script>var x="<div class=cl-paper-row>";</script></head><body>\n'),
                F.array_join(F.col("rows.row"), ""),
                F.lit("<footer><div>end</div>" + button.format("Collapse") + "</footer></body></html>"),
            ).alias("html"),
        )
    )
