"""Column rules: date differences, derived columns, bands, labels and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_DATE_KEY = 19000101
CHURN_WINDOW_DAYS = 180
AT_RISK_PROBABILITY = 0.4
HIGH_CHURN_PROBABILITY = 0.6


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


# -- dates ---------------------------------------------------------------------

def day_diff(start, end) -> Column:
    """Midnights crossed between two moments."""
    return F.datediff(F.to_date(as_column(end)), F.to_date(as_column(start)))


def hour_boundaries(start, end) -> Column:
    """Full-hour marks crossed between two moments (10:59 to 11:01 is one)."""
    first = F.date_trunc("hour", as_column(start))
    last = F.date_trunc("hour", as_column(end))
    return F.timestamp_diff("HOUR", first, last).cast("int")


def elapsed_days(start, end) -> Column:
    """Whole 24-hour periods between two moments, rounded down."""
    return F.floor(F.timestamp_diff("SECOND", as_column(start), as_column(end)) / F.lit(86400)).cast("int")


def date_key(moment) -> Column:
    """yyyymmdd as an int, or the unknown-date member."""
    return F.coalesce(F.date_format(as_column(moment), "yyyyMMdd").cast("int"), F.lit(UNKNOWN_DATE_KEY))


def month_start(moment) -> Column:
    return F.to_date(F.date_trunc("month", as_column(moment)))


def days_from_origin(moment, origin: str) -> Column:
    return F.datediff(F.to_date(as_column(moment)), F.lit(origin).cast("date"))


# -- exact ratios --------------------------------------------------------------

def ratio(numerator, denominator, digits: int, precision: int = 18) -> Column:
    """numerator / denominator in decimal arithmetic, rounded half up; NULL when the denominator is 0."""
    top = as_column(numerator)
    bottom = F.nullif(as_column(denominator).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (top.cast("decimal(20,2)") / bottom).cast(f"decimal({precision},{digits})")


def share(part, whole, digits: int = 4) -> Column:
    """Money part / money whole in decimal arithmetic; 0 when the whole is 0."""
    whole = as_column(whole).cast("decimal(20,2)")
    value = as_column(part).cast("decimal(20,2)") / F.nullif(whole, F.lit(0).cast("decimal(20,2)"))
    return F.coalesce(value, F.lit(0)).cast(f"decimal(18,{digits})")


# -- order and item columns ----------------------------------------------------

def is_delivered(status="order_status") -> Column:
    return F.when(as_column(status) == "delivered", 1).otherwise(0)


def is_canceled(status="order_status") -> Column:
    return F.when(as_column(status) == "canceled", 1).otherwise(0)


def delivery_delta_days() -> Column:
    """Negative when early, NULL while undelivered."""
    return day_diff("order_estimated_delivery_date", "order_delivered_customer_date")


def is_late(delivered="order_delivered_customer_date", estimated="order_estimated_delivery_date") -> Column:
    """Undelivered orders count as on time."""
    return F.when(as_column(delivered) > as_column(estimated), 1).otherwise(0)


def item_gmv(price="price", freight="freight_value") -> Column:
    return (as_column(price) + as_column(freight)).cast("decimal(13,2)")


def freight_ratio(price="price", freight="freight_value") -> Column:
    gmv = as_column(price) + as_column(freight)
    value = as_column(freight).cast("decimal(20,2)") / F.nullif(gmv.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)"))
    return F.when(gmv > 0, value).otherwise(F.lit(0)).cast("decimal(6,4)")


def product_volume() -> Column:
    return F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")


def blank_to_null(text) -> Column:
    trimmed = F.trim(as_column(text))
    return F.when(trimmed != "", trimmed)


def has_text(text) -> Column:
    """1 when anything but trailing blanks is left."""
    return F.when(F.length(F.rtrim(as_column(text))) > 0, 1).otherwise(0)


# -- customer bands and labels -------------------------------------------------

def recency_band(days) -> Column:
    days = as_column(days)
    return (F.when(days <= 30, "0-30 days").when(days <= 90, "31-90 days")
            .when(days <= 180, "91-180 days").otherwise("180+ days"))


def tier(score) -> Column:
    """Five-step score to three labels; NULL is Low."""
    score = as_column(score)
    return F.when(score >= 4, "High").when(score == 3, "Medium").otherwise("Low")


def health_tier(score) -> Column:
    score = as_column(score)
    return F.when(score >= 75, "High").when(score >= 50, "Medium").otherwise("Low")


def is_churned(days, window_days=CHURN_WINDOW_DAYS, inclusive: bool = False) -> Column:
    """Idle longer than the window; ``inclusive`` also counts the window's last day."""
    days = as_column(days)
    window_days = window_days if isinstance(window_days, Column) else F.lit(window_days)
    idle = days >= window_days if inclusive else days > window_days
    return F.when(idle, 1).otherwise(0)


def capped(count, top: int) -> Column:
    return F.least(as_column(count), F.lit(top))


def capped_label(count, top: int) -> Column:
    count = as_column(count)
    return F.when(count >= top, f"{top}+").otherwise(count.cast("string"))


def split_label(moment, cutoff: str) -> Column:
    return F.when(as_column(moment) < F.lit(cutoff).cast("timestamp_ntz"), "TRAIN").otherwise("TEST")


def positive_flag(value) -> Column:
    return F.when(as_column(value) > 0, 1).otherwise(0)


def single_flag(count) -> Column:
    return F.when(as_column(count) == 1, 1).otherwise(0)


def rfm_code(recency="recency_score", frequency="frequency_score", monetary="monetary_score") -> Column:
    return F.concat(*[as_column(c).cast("string") for c in (recency, frequency, monetary)])


# -- churn signals -------------------------------------------------------------

def score_badness(score) -> Column:
    """Five-step score to 0 (best) .. 1 (worst); NULL is the middle."""
    score = as_column(score)
    value = F.lit(1).cast("decimal(10,4)") - (score.cast("decimal(10,4)") - 1) / F.lit(4).cast("decimal(10,4)")
    return F.coalesce(value, F.lit(0.5)).cast("decimal(10,6)")


def delivery_badness(late_share="pct_late_deliveries") -> Column:
    return F.coalesce(as_column(late_share), F.lit(0)).cast("decimal(10,6)")


def sentiment_badness(review_score="avg_review_score") -> Column:
    value = F.lit(1).cast("decimal(10,4)") - as_column(review_score).cast("decimal(10,4)") / F.lit(5).cast("decimal(10,4)")
    return F.coalesce(value, F.lit(0.5)).cast("decimal(10,6)")


def at_risk(churned="is_churned", probability="churn_probability") -> Column:
    return (as_column(churned) == 1) | F.coalesce(as_column(probability) > AT_RISK_PROBABILITY, F.lit(False))


def churn_driver_summary(churned="is_churned", probability="churn_probability") -> Column:
    by_rule = as_column(churned) == 1
    by_model = F.coalesce(as_column(probability) > AT_RISK_PROBABILITY, F.lit(False))
    return (F.when(by_rule & by_model, "Rule + model agree: churned")
            .when(by_rule, "Rule-based: no order in 180+ days")
            .when(by_model, "Model-flagged: at risk")
            .otherwise("Active"))


def primary_driver(delivery, sentiment, recency, monetary) -> Column:
    """Label of the worst signal; the first two need more than 0.3 to win."""
    delivery, sentiment, recency, monetary = map(as_column, (delivery, sentiment, recency, monetary))
    return (F.when((delivery == F.greatest(delivery, sentiment, recency, monetary)) & (delivery > 0.3),
                   "Delivery experience")
            .when((sentiment == F.greatest(sentiment, recency, monetary)) & (sentiment > 0.3), "Low satisfaction")
            .when(recency >= monetary, "Lapsed / inactive")
            .otherwise("Low historical value"))


def urgency_score(probability, churned, monetary, days) -> Column:
    """100 * (0.4 likelihood + 0.4 value at stake + 0.2 time pressure), one decimal."""
    likelihood = F.coalesce(as_column(probability), as_column(churned)).cast("decimal(10,6)")
    value = F.lit(1).cast("decimal(10,6)") - as_column(monetary)
    waited = F.coalesce(as_column(days), F.lit(0)).cast("decimal(10,0)") / F.lit(360).cast("decimal(10,0)")
    pressure = F.least(waited, F.lit(1).cast("decimal(10,0)"))
    total = F.lit("0.4").cast("decimal(2,1)") * (likelihood + value) + F.lit("0.2").cast("decimal(2,1)") * pressure
    return F.round(total * 100, 1).cast("decimal(6,1)")


# -- dashboard columns ---------------------------------------------------------

CLV_BANDS = ("No CLV", "R$0", "R$0.01–1", "R$1–5", "R$5–20", "R$20–100", "R$100+")


def clv_band_sort(clv) -> Column:
    clv = as_column(clv)
    return (F.when(clv.isNull(), 0).when(clv == 0, 1).when(clv <= 1, 2).when(clv <= 5, 3)
            .when(clv <= 20, 4).when(clv <= 100, 5).otherwise(6))


def clv_band(clv) -> Column:
    return F.element_at(F.array(*[F.lit(b) for b in CLV_BANDS]), clv_band_sort(clv) + 1)


def churn_bucket_sort(probability) -> Column:
    """1..10, left-closed tenths; NULL sorts with the first, as a blank compares below 0.1."""
    tenth = F.floor(F.coalesce(as_column(probability), F.lit(0)).cast("decimal(10,6)") * 10) + 1
    return F.least(tenth, F.lit(10)).cast("int")


def churn_bucket(probability) -> Column:
    low = (churn_bucket_sort(probability) - 1).cast("decimal(4,1)") / F.lit(10).cast("decimal(4,0)")
    return F.format_string("%.1f–%.1f", low.cast("double"), (low + F.lit("0.1").cast("decimal(2,1)")).cast("double"))


def is_churn_risk(probability) -> Column:
    return F.when(as_column(probability) >= HIGH_CHURN_PROBABILITY, 1).otherwise(0)


def clv_churn_quadrant(clv, probability, clv_cutoff, churn_cutoff=HIGH_CHURN_PROBABILITY) -> Column:
    """Customers without a prediction fall on the low-value side; a missing probability counts as low."""
    clv_cutoff = clv_cutoff if isinstance(clv_cutoff, Column) else F.lit(clv_cutoff)
    high_value = F.coalesce(as_column(clv) >= clv_cutoff, F.lit(False))
    high_churn = F.coalesce(as_column(probability) >= churn_cutoff, F.lit(False))
    return (F.when(high_churn & high_value, "Retain").when(high_value, "Grow")
            .when(high_churn, "Reactivate").otherwise("Monitor"))


def priority_sort(priority) -> Column:
    priority = as_column(priority)
    return F.when(priority == "HIGH", 1).when(priority == "MED", 2).when(priority == "LOW", 3).otherwise(4)


def sentiment_label(compound) -> Column:
    compound = as_column(compound)
    return (F.when(compound >= 0.05, "positive").when(compound <= -0.05, "negative")
            .when(compound.isNotNull(), "neutral"))


COMPOUND_BUCKETS = ("-1.0 to -0.6", "-0.6 to -0.3", "-0.3 to -0.05", "-0.05 to 0.05",
                    "0.05 to 0.3", "0.3 to 0.6", "0.6 to 1.0")


def compound_bucket_order(compound) -> Column:
    c = as_column(compound)
    return (F.when(c < -0.6, 1).when(c < -0.3, 2).when(c < -0.05, 3).when(c <= 0.05, 4)
            .when(c <= 0.3, 5).when(c <= 0.6, 6).otherwise(7))


def compound_bucket(compound) -> Column:
    return F.element_at(F.array(*[F.lit(b) for b in COMPOUND_BUCKETS]), compound_bucket_order(compound))


def sarcasm(review_score="review_score", compound="compound_score") -> Column:
    return F.coalesce((as_column(review_score) == 1) & (as_column(compound) > 0.3), F.lit(False))


def geo_label(state, gmv_share, threshold: float = 0.02) -> Column:
    return F.when(as_column(gmv_share) < threshold, "Other").otherwise(as_column(state))
