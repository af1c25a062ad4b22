"""Message-log lines to typed rows, and the time between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.casts import number, parse_timestamp

# The two message shapes, and their groups in order.
MESSAGES = {
    "Update": (
        r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d+ [AP]M): (\w+): ([\w.]+): Update : (\d{2}:\d{2} [AP]M) : Port (\d+) : ([\w.]+) (\w+) ([\d,.-]+) \((\w+)\)",
        ("log_ts", "level", "source", "trade_time", "port", "security", "direction", "quantity", "user"),
    ),
    "Order": (
        r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d+ [AP]M): (\w+): ([\w.]+): Order : (\d{2}:\d{2} [AP]M) : (\w+) (\w+) ([\d,.-]+) ([\w. ]+?) FILLED ([\d,.-]+) @ ([\d.]+) \((\w+)\)",
        ("log_ts", "level", "source", "trade_time", "action", "side", "quantity", "security", "filled_qty", "price", "user"),
    ),
}
FIELDS = (
    "log_ts", "level", "source", "trade_time", "port", "security", "direction",
    "quantity", "user", "action", "side", "filled_qty", "price",
)
NUMERIC = ("port", "quantity", "filled_qty", "price")
STAMP_LAYOUT = "yyyy-MM-dd hh:mm:ss"
SEPARATOR = "\x1f"


def _stamp(text: Column) -> Column:
    """12-hour stamp with a fraction of any length, without a zone."""
    whole = F.concat_ws(" ", F.regexp_extract(text, r"^(.*)\.\d+ [AP]M$", 1), F.right(text, F.lit(2)))
    micros = F.rpad(F.substring(F.regexp_extract(text, r"\.(\d+) [AP]M$", 1), 1, 6), 6, "0").try_cast("long")
    at = parse_timestamp(whole, f"{STAMP_LAYOUT} a").cast("timestamp_ntz")
    return at + F.make_dt_interval(secs=(micros / F.lit(1_000_000)).cast("decimal(18,6)"))


def parse_messages(lines: DataFrame, line: str = "line") -> DataFrame:
    """Raw text fields per line; the first shape that fits wins, else ``UNKNOWN`` with the line."""
    text = F.col(line)
    # One pass per shape: a match is rewritten to its groups, split apart again.
    fields = F.array(F.lit("UNKNOWN"))
    for name, (pattern, groups) in reversed(MESSAGES.items()):
        rewrite = SEPARATOR.join([name, *[f"${n}" for n in range(1, len(groups) + 1)]])
        parts = F.split(F.regexp_replace(text, f"{pattern}(?s:.*)$", rewrite), SEPARATOR)
        fields = F.when(text.rlike(pattern), parts).otherwise(fields)
    shaped = lines.withColumn("_fields", fields).withColumn("msg_type", F.col("_fields")[0])

    def field_of(name: str) -> Column:
        value = F.lit(None).cast("string")
        for kind, (_, groups) in MESSAGES.items():
            if name in groups:
                value = F.when(
                    F.col("msg_type") == kind, F.get("_fields", F.lit(groups.index(name) + 1))
                ).otherwise(value)
        return value

    return shaped.select(
        *[c for c in lines.columns if c != line],
        "msg_type",
        *[field_of(n).alias(n) for n in FIELDS],
        F.when(F.col("msg_type") == "UNKNOWN", text).alias("raw"),
    )


def type_messages(raw: DataFrame) -> DataFrame:
    """Typed fields: timestamp, time of day as ``HH:mm:ss`` text, numbers without commas."""
    clock = F.date_format(parse_timestamp(F.col("trade_time"), "hh:mm a"), "HH:mm:ss")
    figures = {n: number(F.replace(F.col(n), F.lit(","), F.lit(""))) for n in NUMERIC}
    return raw.withColumns({"log_ts": _stamp(F.col("log_ts")), "trade_time": clock, **figures})


def elapsed(
    df: DataFrame,
    timestamp: str,
    tie_break: str,
    keys: Sequence[str] = (),
    output: str = "elapsed_s",
) -> DataFrame:
    """Seconds since the previous row in time order, over the whole table or per key.

    ``tie_break`` is unique per row.  Even the table-wide order needs no single
    sorted partition: repeated timestamps collapse first (all but the first row
    of one differ by zero); the predecessor of a timestamp is then looked for
    within its second, else in the earlier seconds of its day, else in the
    earlier days.  A sort so sees at most the microseconds of one second, the
    seconds of one day or the days of the table.
    """
    stamped = df.withColumn("_us", F.unix_micros(F.col(timestamp).cast("timestamp")))
    second = F.floor(F.col("_us") / 1_000_000)
    distinct = (
        stamped.where(F.col("_us").isNotNull())
        .groupBy(*keys, "_us")
        .agg(F.min(tie_break).alias("_first"))
        .withColumns({"_second": second, "_day": F.floor(second / 86_400)})
    )
    seconds = distinct.groupBy(*keys, "_day", "_second").agg(F.max("_us").alias("_last"))
    days = seconds.groupBy(*keys, "_day").agg(F.max("_last").alias("_last"))

    def before(frame: DataFrame, group: Sequence[str], order: str, value: str, name: str) -> DataFrame:
        by = [*keys, *group] or [F.lit(0)]
        return frame.withColumn(name, F.lag(value).over(Window.partitionBy(*by).orderBy(order)))

    by_day = before(days, [], "_day", "_last", "_day_before").drop("_last")
    by_second = before(seconds, ["_day"], "_second", "_last", "_second_before").drop("_last")
    carry = _join_on(by_second, by_day, [*keys, "_day"]).select(
        *keys, "_second", F.coalesce("_second_before", "_day_before").alias("_carried")
    )
    in_second = before(distinct, ["_second"], "_us", "_us", "_us_before").select(
        *keys, "_second", "_us", "_first", "_us_before"
    )
    previous = _join_on(in_second, carry, [*keys, "_second"]).select(
        *[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)],
        F.col("_us").alias("_at"),
        "_first",
        F.coalesce("_us_before", "_carried").alias("_before"),
    )
    on = (F.col("_us") == F.col("_at")) & (F.col(tie_break) == F.col("_first"))
    for n, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{n}"))
    gap = (
        F.when(F.col("_us").isNull(), F.lit(None).cast("double"))
        .when(F.col("_at").isNull(), F.lit(0.0))
        .otherwise((F.col("_us") - F.col("_before")) / F.lit(1e6))
    )
    return stamped.join(previous, on, "left").select(*df.columns, gap.alias(output))


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on NULL-matching keys; the right side's keys go."""
    names = {k: f"_r_{k}" for k in keys}
    side = right.withColumnsRenamed(names)
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    return left.join(side, on).drop(*names.values())
