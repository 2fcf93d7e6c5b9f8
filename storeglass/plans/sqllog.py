"""SQL query log: parsing of the lines and the reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storeglass.functions.exprs import at
from storeglass.operators.materialize import materialize

# Line prefix -> log type, limits in milliseconds, statement keywords in order of precedence.
LOG_TYPES = {
    "[SQL Query]": "sql_query", "[SQL Params]": "sql_params",
    "[SQL Execution Time]": "sql_performance", "[SQL Error]": "sql_error",
}
SLOW_MS, MEDIUM_MS = 1000, 500
KEYWORDS = ("SELECT", "INSERT", "UPDATE", "DELETE", "CREATE")
# Steps of the time histogram in seconds, second to day, then 7, 30, 90, 365 and 3650 days.
STEPS = (1, 5, 10, 30, 60, 300, 600, 1800, 3600, 10800, 43200, 86400, 604800, 2592000, 7776000, 31536000, 315360000)


def epoch() -> Column:
    return at("1970-01-01")


def parse_sql_log(lines: DataFrame, trim: bool = False) -> DataFrame:
    """Log lines -> typed columns. Works on batches and streams alike.

    `lines` has message and timestamp; fields that came along (sql_query, ...) are used where the message holds none.
    The keyword is looked for at the start of a line of the statement as it is; `trim` ignores leading blanks.
    """
    message = F.col("message")
    log_type = None
    for prefix, name in LOG_TYPES.items():
        test = message.startswith(prefix)
        log_type = F.when(test, name) if log_type is None else log_type.when(test, name)
    typed = lines.withColumn("log_type", log_type)

    def found(kind: str, pattern: str):
        # An empty text is a hit where the pattern allows one, so the type decides, not the text.
        return F.when(F.col("log_type") == kind, F.regexp_extract(message, pattern, 1))

    def given(name: str, type_name: str = "string"):
        return F.col(name).cast(type_name) if name in lines.columns else F.lit(None).cast(type_name)

    time_text = found("sql_performance", r"\[SQL Execution Time\] ([+-]?\d+(?:\.\d+)?)ms")
    time_ms = F.coalesce(F.when(time_text != "", time_text.cast("double")), given("execution_time_ms", "double"))
    parsed = typed.select(
        "message", "log_type", "timestamp",
        F.coalesce(found("sql_query", r"\[SQL Query\] ([^\n]*)"), given("sql_query")).alias("sql_query"),
        F.coalesce(found("sql_params", r"\[SQL Params\] ([^\n]*)"), given("sql_params")).alias("sql_params"),
        time_ms.alias("execution_time_ms"),
        F.coalesce(found("sql_error", r"\[SQL Error\] ([^\n]*)"), given("error_message")).alias("error_message"),
    )
    spent = F.col("execution_time_ms")
    category = F.when(F.col("log_type") == "sql_error", "error").when(
        (F.col("log_type") == "sql_performance") & spent.isNotNull(),
        F.when(spent > SLOW_MS, "slow").when(spent > MEDIUM_MS, "medium").otherwise("fast"))
    kind = None
    for keyword in KEYWORDS:
        hit = F.col("sql_query").rlike(rf"(?m)^\s*{keyword}" if trim else f"(?m)^{keyword}")
        kind = F.when(hit, keyword) if kind is None else kind.when(hit, keyword)
    return parsed.select(
        "message", "log_type", "sql_query", "sql_params", "execution_time_ms", "error_message",
        category.alias("performance_category"),
        F.when(F.col("sql_query").isNotNull(), kind.otherwise("OTHER")).alias("query_type"),
        F.col("timestamp").alias("log_timestamp"),
    )


def log_by_category(log: DataFrame, n: int = 5) -> DataFrame:
    return log.filter(F.col("performance_category").isNotNull()).groupBy("performance_category").agg(
        F.count("*").alias("n")).orderBy(F.desc("n"), "performance_category").limit(n)


def log_time_trend(log: DataFrame, buckets: int = 100) -> DataFrame:
    """Average time per interval; the step is the smallest one that needs at most `buckets` intervals for the span.

    The log is read once: sums per second are kept (one row per second of the span), the step is chosen from them.
    """
    second = F.floor(F.timestamp_diff("MICROSECOND", epoch(), F.col("log_timestamp")) / 1_000_000)
    seconds = materialize(
        log.filter(F.col("execution_time_ms").isNotNull()).groupBy(second.alias("_second"))
        .agg(F.sum("execution_time_ms").alias("_sum"), F.count("*").alias("_n")))
    spread = F.max("_second") - F.min("_second")
    step = F.lit(STEPS[-1])
    for size in reversed(STEPS):
        step = F.when(spread <= F.lit(size * buckets), F.lit(size)).otherwise(step)
    chosen = seconds.withColumn("_step", seconds.agg(step).scalar())
    start = F.floor(F.col("_second") / F.col("_step")) * F.col("_step")
    return chosen.groupBy(start.alias("_start")).agg((F.sum("_sum") / F.sum("_n")).alias("avg_ms")).select(
        (epoch() + F.make_dt_interval(secs=F.col("_start"))).alias("bucket"), "avg_ms").orderBy("bucket")


def log_by_type(log: DataFrame, n: int = 10, only_queries: bool = False) -> DataFrame:
    """Events per statement type. Time and error events carry the statement too and count, unless `only_queries`."""
    typed = log.filter(F.col("query_type").isNotNull())
    if only_queries:
        typed = typed.filter(F.col("log_type") == "sql_query")
    return typed.groupBy("query_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "query_type").limit(n)


def slowest_statements(log: DataFrame, n: int = 10) -> DataFrame:
    timed = log.filter((F.col("execution_time_ms") >= 0) & F.col("sql_query").isNotNull())
    return timed.groupBy("sql_query").agg(F.max("execution_time_ms").alias("max_ms")).orderBy(
        F.desc("max_ms"), "sql_query").limit(n)


def statement_latency(log: DataFrame) -> DataFrame:
    """Latency per statement against the mean of the statement means; the fastest and the slowest are marked."""
    # Written once per statement, so that the log is not read again for the means.
    per_statement = materialize(
        log.filter(F.col("execution_time_ms").isNotNull() & F.col("sql_query").isNotNull()).groupBy("sql_query").agg(
            F.avg("execution_time_ms").alias("avg_ms"), F.min("execution_time_ms").alias("min_ms"),
            F.max("execution_time_ms").alias("max_ms"), F.count("*").alias("n")))
    # Three values in one row; among equal means the smaller statement text wins.
    mark = per_statement.agg(F.struct(
        F.avg("avg_ms").alias("mean"),
        F.min(F.struct("avg_ms", "sql_query")).alias("fastest"),
        F.min(F.struct((-F.col("avg_ms")).alias("k"), F.col("sql_query").alias("sql_query"))).alias("slowest"),
    )).scalar()
    label = F.when(F.col("avg_ms") > F.col("_m.mean") * 2, "slow").when(F.col("avg_ms") < F.col("_m.mean") * 0.5, "fast")
    return per_statement.withColumn("_m", mark).select(
        "sql_query", "avg_ms", "min_ms", "max_ms", "n", label.alias("label"),
        (F.col("sql_query") == F.col("_m.fastest.sql_query")).alias("is_fastest"),
        (F.col("sql_query") == F.col("_m.slowest.sql_query")).alias("is_slowest"))


def speed_up(latency: DataFrame, before: str, after: str) -> DataFrame:
    """How many times faster one statement is than another, rounded to one digit."""
    average = lambda text: F.avg(F.when(F.col("sql_query") == F.lit(text), F.col("avg_ms")))
    return latency.agg(average(before).alias("before_ms"), average(after).alias("after_ms")).withColumn(
        "ratio", F.when(F.col("after_ms") > 0, F.round(F.col("before_ms") / F.col("after_ms"), 1)))


def slow_statements(log: DataFrame, min_ms: float = 100, limit: int = 20) -> DataFrame:
    """Statements with a mean above `min_ms`."""
    return log.filter(F.col("execution_time_ms").isNotNull() & F.col("sql_query").isNotNull()).groupBy("sql_query").agg(
        F.count("*").alias("calls"), F.sum("execution_time_ms").alias("total_ms"),
        F.avg("execution_time_ms").alias("mean_ms"),
    ).filter(F.col("mean_ms") > min_ms).orderBy(F.desc("mean_ms"), "sql_query").limit(limit)
