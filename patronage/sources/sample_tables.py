"""The sample tables under canonical names.

Maps the order-management sample (customer, nation, orders, lineitem, part,
supplier, documents) onto the raw tables the marts start from. What the sample
lacks (payments, reviews, delivery dates, model scores) is derived from its keys
by fixed expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


FIRST_RUN = "1998-01-01"
SECOND_RUN = "2000-01-01"
ML_CUTOFF = "2001-01-01"

# column types of the sample files, given so that no job is spent on reading footers
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# status letter -> status; type without a translation
STATUS = {"F": "delivered", "P": "shipped", "O": "canceled"}
UNTRANSLATED_TYPE = "PROMO"


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _plus(unit: str, amount: Column, moment: str = "o_orderdate") -> Column:
    return F.timestamp_add(unit, amount.cast("int"), F.col(moment))


def _scaled(value: Column, divisor: int, kind: str) -> Column:
    return (value.cast("decimal(18,2)") / F.lit(divisor).cast("decimal(6,0)")).cast(kind)


def _price() -> Column:
    return F.col("l_extendedprice").cast("decimal(12,2)")


# stand-in lexicon of words that are frequent in the sample texts
LEXICON = {"the": "0.5", "der": "-0.4", "die": "0.3", "des": "-0.6", "les": "0.2", "rewh": "1.9", "orre": "-2.1",
           "ononst": "2.4", "hehely": "-1.5", "ing": "1.1"}
SAMPLE_NEGATORS = ("and", "und")
SAMPLE_BOOSTERS = {"that": "0.293", "la": "0.293", "que": "-0.293"}


@dataclass(frozen=True)
class SampleTables:
    spark: SparkSession
    path: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        return self._customers(F.col("c_nationkey"))

    @cached_property
    def moved_customers(self) -> DataFrame:
        """The later snapshot: every tenth customer has moved to the next nation."""
        moved = F.when(F.col("c_custkey") % 10 == 0, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
        return self._customers(moved)

    def _customers(self, nation_key: Column) -> DataFrame:
        customer = self.read("customer").withColumn("nation_key", nation_key)
        nation = self.read("nation").select(F.col("n_nationkey").alias("nation_key"), "n_name")
        return customer.join(nation, "nation_key").select(
            _text("c_custkey").alias("customer_id"),
            _text("c_custkey").alias("customer_unique_id"),
            _text("nation_key").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        status = F.col("o_orderstatus")
        label = F.coalesce(*[F.when(status == letter, name) for letter, name in STATUS.items()])
        shipped = status != "O"
        return self.read("orders").select(
            _text("o_orderkey").alias("order_id"),
            _text("o_custkey").alias("customer_id"),
            label.alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            _plus("HOUR", key % 48).alias("order_approved_at"),
            F.when(shipped, _plus("DAY", F.lit(2))).alias("order_delivered_carrier_date"),
            F.when(shipped, _plus("DAY", F.lit(3) + (key * 7) % 40)).alias("order_delivered_customer_date"),
            _plus("DAY", F.lit(30)).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def items(self) -> DataFrame:
        """Order lines without a line id of their own; see ``numbered_items``."""
        return self.read("lineitem").select(
            _text("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            _text("l_partkey").alias("product_id"),
            _text("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.round(_price() * (1 - F.col("l_discount").cast("decimal(4,2)")), 2).cast("decimal(12,2)").alias("price"),
            F.round(_price() * F.col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(12,2)").alias("freight_value"),
        )

    @cached_property
    def numbered_items(self) -> DataFrame:
        """Order lines with an id that is unique inside the order (line numbers repeat in the sample).

        An order has a handful of lines, so a window by order stays small. It is by the order's id as text, so that lines meet
        their orders where the window left them.
        """
        lines = self.read("lineitem").select(
            _text("l_orderkey").alias("order_id"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount",
            "l_tax")
        tie_break = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax"]
        inside = Window.partitionBy("order_id").orderBy("l_linenumber", *tie_break)
        placed = lines.withColumn("row", F.row_number().over(inside))
        return placed.select(
            "order_id",
            F.col("row").cast("int").alias("order_item_id"),
            _text("l_partkey").alias("product_id"),
            _text("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.round(_price() * (1 - F.col("l_discount").cast("decimal(4,2)")), 2).cast("decimal(12,2)").alias("price"),
            F.round(_price() * F.col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(12,2)").alias("freight_value"),
        )

    @cached_property
    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.read("part").select(
            _text("p_partkey").alias("product_id"),
            F.when(key % 50 != 0, F.col("p_type")).alias("product_category_name"),
            F.length("p_name").cast("string").alias("product_name_lenght"),
            F.when(key % 30 == 0, F.lit("n/a")).otherwise((F.col("p_size") * 10).cast("string"))
            .alias("product_description_lenght"),
            (key % 7).cast("string").alias("product_photos_qty"),
            F.col("p_retailprice").alias("product_weight_g"),
            F.col("p_size").cast("double").alias("product_length_cm"),
            (key % 30 + 1).cast("double").alias("product_height_cm"),
            F.when(key % 20 != 0, key % 40).cast("double").alias("product_width_cm"),
        )

    @cached_property
    def category_translation(self) -> DataFrame:
        return (self.read("part").select("p_type").distinct().where(F.col("p_type") != UNTRANSLATED_TYPE)
                .select(F.col("p_type").alias("product_category_name"),
                        F.upper("p_type").alias("product_category_name_english")))

    @cached_property
    def sellers(self) -> DataFrame:
        nation = self.read("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return self.read("supplier").join(nation, "s_nationkey").select(
            _text("s_suppkey").alias("seller_id"),
            _text("s_nationkey").alias("seller_zip_code_prefix"),
            F.col("s_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        """One payment per order; every twentieth order pays its second half by voucher."""
        key = F.col("o_orderkey")
        total = F.col("o_totalprice").cast("decimal(12,2)")
        half = F.round(total / F.lit(2).cast("decimal(1,0)"), 2).cast("decimal(12,2)")
        split = key % 20 == 0

        def payment(number: int, kind: Column, value: Column) -> Column:
            return F.struct(F.lit(number).alias("payment_sequential"), kind.alias("payment_type"),
                            (F.lit(1) + key % 12).cast("int").alias("payment_installments"),
                            value.cast("decimal(12,2)").alias("payment_value"))

        own = F.col("o_orderpriority")
        rows = F.when(split, F.array(payment(1, own, half), payment(2, F.lit("voucher"), total - half))).otherwise(
            F.array(payment(1, own, total)))
        return self.read("orders").select(_text("o_orderkey").alias("order_id"), F.inline(rows))

    @cached_property
    def _reviewed(self) -> DataFrame:
        key = F.col("o_orderkey")
        sizes = self.read("documents").agg(F.count(F.lit(1)).alias("doc_count"))
        own = F.struct(F.concat(F.lit("R"), _text("o_orderkey")).alias("review_id"))
        repeated = F.struct(F.concat(F.lit("R"), (key - 1).cast("string")).alias("review_id"))
        ids = F.when(key % 100 == 2, F.array(own, repeated)).otherwise(F.array(own))
        return (self.read("orders").where(key % 10 != 0).crossJoin(F.broadcast(sizes))
                .select("o_orderkey", F.inline(ids), "o_orderdate",
                        F.when(key % 2 != 0, key % F.col("doc_count")).alias("doc_id")))

    @cached_property
    def reviews(self) -> DataFrame:
        """Reviews of nine orders in ten; 1% of the review ids repeat under another order."""
        return self._with_texts(self._reviewed)

    @cached_property
    def dealt_reviews(self) -> DataFrame:
        """The same rows in four tasks a core, for work that is heavy per text: they are dealt before they meet their texts."""
        return self._with_texts(self._reviewed.repartition(4 * self.spark.sparkContext.defaultParallelism, "o_orderkey"))

    def _with_texts(self, reviewed: DataFrame) -> DataFrame:
        documents = self.read("documents").select("doc_id", F.col("text").alias("review_comment_message"))
        return reviewed.join(documents, "doc_id", "left").select(*self._review_columns(F.col("o_orderkey")),
                                                                 "review_comment_message")

    @cached_property
    def review_heads(self) -> DataFrame:
        """Reviews for jobs that ask only whether there is a text: 'text', '' for a blank one, NULL without one.

        Every text is looked at where it is read, and one short row per document meets the reviews.
        """
        marker = F.when(F.trim("text") != "", "text").when(F.col("text").isNotNull(), "").alias("review_comment_message")
        return self._reviewed.join(self.read("documents").select("doc_id", marker), "doc_id", "left").select(
            *self._review_columns(F.col("o_orderkey")), "review_comment_message")

    @staticmethod
    def _review_columns(key: Column) -> list[Column]:
        created = _plus("DAY", F.lit(35) + key % 10)
        return [
            F.col("review_id"),
            _text("o_orderkey").alias("order_id"),
            (F.lit(1) + key % 5).cast("double").alias("review_score"),
            F.when(key % 3 == 0, F.lit("  ")).when(key % 3 == 1, F.lit(" ok ")).alias("review_comment_title"),
            created.alias("review_creation_date"),
            _plus("DAY", F.lit(37) + key % 10).alias("review_answer_timestamp"),
        ]

    @cached_property
    def lexicon(self) -> DataFrame:
        return self.spark.createDataFrame(list(LEXICON.items()), "word string, valence string")

    # -- stand-ins for model output ------------------------------------------

    def customer_scores(self) -> DataFrame:
        """Scores by fixed expressions of the customer key, some of them missing."""
        k = F.col("c_custkey")
        clv = F.when(k % 7 != 0, _scaled((k * 91) % 4000, 100, "decimal(14,2)"))
        return self.read("customer").select(
            _text("c_custkey").alias("customer_unique_id"),
            F.when(k % 11 != 0, _scaled((k * 37) % 1000, 1000, "decimal(6,4)")).alias("churn_probability"),
            clv.alias("clv_predicted_6m"),
            _scaled(clv * 8, 10, "decimal(14,2)").alias("clv_ci_lower"),
            _scaled(clv * 12, 10, "decimal(14,2)").alias("clv_ci_upper"),
            F.when(k % 3 != 0, _scaled((k * 53) % 2001 - 1000, 1000, "decimal(6,4)")).alias("avg_sentiment_score"),
            F.when(k % 4 != 0, _scaled((k * 17) % 3000, 10, "decimal(10,1)")).alias("expected_next_purchase_days"),
            (k % 5).cast("int").alias("km_cluster"),
        )
