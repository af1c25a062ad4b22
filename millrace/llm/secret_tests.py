"""Secret scan with a battery of randomness tests.

Three kinds are found by form alone (``BASE``).  Beyond them, every maximal run
of at least ``MIN_RUN`` letters, digits, ``+ / _ -`` is tested for randomness
over the alphabet of its inferred encoding:

* chi-squared uniformity of its symbols (normal approximation, upper tail),
* the number of runs above and below the middle of the alphabet (both tails),
* lag-one serial correlation of the symbols' values (both tails).

Fisher's method joins the three p-values; a small one says that the run is
structured, as words and numbered names are.  Runs are tested in strata of
encoding and length class, and in each the Benjamini-Hochberg rule at ``level``
decides which are dismissed as structured, so that at most that share of the
dismissed runs is truly random.  Short runs give the tests no power, so one
that is not dismissed counts only if its length times the bits of its alphabet
reach ``min_bits``.  The rule's threshold is found on a fixed grid of p-values
from counts per stratum and grid cell: no global sort, at most the next lower
grid point is taken.

Positions count code points, ends are exclusive.  A tested run that overlaps a
span found by form is not added.

Defined cases: null texts are empty; repeated rows and ids are judged row by
row; very long runs are tested whole; empty tables give empty results; columns
other than the id and the text are ignored.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import find_spans
from millrace.session import stage

#: Kind, pattern, the group that is measured, its least length, a quick test of the text.
BASE = (
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        6,
        r"(?i:passw|secret|token|api_?key)",
    ),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 20, r"AKIA[A-Z0-9]"),
    ("hex", r"([0-9a-f]+)", 1, 24, r"[0-9a-f]{24}"),
)

MIN_RUN = 20
RUN = r"([A-Za-z0-9+/_-]{20,})"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings in the order of inference; the first whose alphabet holds the run.
ENCODINGS = (
    ("decimal", "[0-9]+", DIGITS),
    ("hex", "[0-9a-f]+", DIGITS + "abcdef"),
    ("HEX", "[0-9A-F]+", DIGITS + "ABCDEF"),
    ("lower", "[a-z]+", LOWER),
    ("base32", "[A-Z2-7]+", UPPER + "234567"),
    ("letters", "[A-Za-z]+", UPPER + LOWER),
    ("base36", "[0-9a-z]+", DIGITS + LOWER),
    ("base62", "[0-9A-Za-z]+", DIGITS + UPPER + LOWER),
    ("base64", "[0-9A-Za-z+/]+", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "[0-9A-Za-z_-]+", UPPER + LOWER + DIGITS + "-_"),
    ("mixed", ".+", UPPER + LOWER + DIGITS + "+/-_"),
)
#: Cells of the grid of p-values: cell c holds p in (10 ** -((c + 1) / 8), 10 ** -(c / 8)].
CELLS_PER_DECADE, CELLS = 8, 400


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution for z >= 0 (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / 2.5066282746310002 * poly


def _p(z: Column, both: bool) -> Column:
    upper = _tail(F.least(F.abs(z), F.lit(30.0)))
    p = 2 * upper if both else F.when(z >= 0, upper).otherwise(1 - upper)
    return F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-45))


def randomness(runs: DataFrame) -> DataFrame:
    """``runs`` (with ``token``) with encoding, size of its alphabet, length and the joint ``p`` of randomness."""
    encoding = symbols = None
    for name, pattern, alphabet in reversed(ENCODINGS):
        fits = F.col("token").rlike(f"^{pattern}$")
        encoding = F.lit(name) if encoding is None else F.when(fits, name).otherwise(encoding)
        symbols = F.lit(alphabet) if symbols is None else F.when(fits, alphabet).otherwise(symbols)
    n, a = F.col("_n"), F.col("_a")
    out = runs.withColumns({"encoding": encoding, "_s": symbols, "_n": F.length("token").cast("double")})
    squares = F.aggregate(
        F.split("_s", ""),
        F.lit(0.0),
        lambda acc, s: acc + F.pow(F.length("token") - F.length(F.replace(F.col("token"), s, F.lit(""))), F.lit(2)),
    )
    values = F.transform(F.split("token", ""), lambda c: (F.position(c, F.col("_s")) - 1).cast("double"))
    out = out.withColumns({"_a": F.length("_s").cast("double"), "_squares": squares, "_v": values})
    total = F.aggregate("_v", F.lit(0.0), lambda acc, v: acc + v)
    high = F.aggregate("_v", F.lit(0.0), lambda acc, v: acc + F.when(v * 2 >= F.col("_a"), 1.0).otherwise(0.0))
    out = out.withColumns({"_mean": total / n, "_high": high})
    ahead, behind = F.slice("_v", F.lit(2), F.size("_v") - 1), F.slice("_v", F.lit(1), F.size("_v") - 1)
    changes = F.zip_with(behind, ahead, lambda x, y: ((x * 2 >= F.col("_a")) != (y * 2 >= F.col("_a"))).cast("double"))
    lagged = F.zip_with(behind, ahead, lambda x, y: (x - F.col("_mean")) * (y - F.col("_mean")))
    plus = lambda acc, v: acc + v
    out = out.withColumns(
        {
            "_runs": 1 + F.aggregate(changes, F.lit(0.0), plus),
            "_lag": F.aggregate(lagged, F.lit(0.0), plus),
            "_var": F.aggregate("_v", F.lit(0.0), lambda acc, v: acc + (v - F.col("_mean")) * (v - F.col("_mean"))),
        }
    )
    free = a - 1
    uniform = (a / n * F.col("_squares") - n - free) / F.sqrt(2 * free * (1 - 1 / n))
    mixed = F.col("_high") * (n - F.col("_high"))
    spread = 2 * mixed * (2 * mixed - n) / (n * n * (n - 1))
    runs_z = F.when(spread > 0, (F.col("_runs") - 1 - 2 * mixed / n) / F.sqrt(F.greatest(spread, F.lit(1e-9)))).otherwise(30.0)
    serial = F.when(F.col("_var") > 0, (F.col("_lag") / F.greatest(F.col("_var"), F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(30.0)
    half = -(F.log(_p(uniform, False)) + F.log(_p(runs_z, True)) + F.log(_p(serial, True)))
    joint = F.exp(-half) * (1 + half + half * half / 2)
    return out.withColumn("p", F.greatest(joint, F.lit(1e-49))).drop(
        "_s", "_squares", "_v", "_mean", "_high", "_runs", "_lag", "_var"
    ).withColumnsRenamed({"_a": "alphabet", "_n": "length"})


def _stratum() -> list[Column]:
    # Length classes double: 20-31, 32-63, 64-127, ...
    return [F.col("encoding"), F.floor(F.log2("length")).alias("length_class")]


def _dismissed(tested: DataFrame, level: float) -> DataFrame:
    """Per stratum the largest grid point t with p <= t dismissed by the Benjamini-Hochberg rule."""
    cell = F.least(F.floor(-F.log10("p") * CELLS_PER_DECADE), F.lit(CELLS)).cast("int")
    counts = tested.groupBy(*_stratum(), cell.alias("cell")).agg(F.count("*").alias("n"))
    per = counts.groupBy("encoding", "length_class").agg(
        F.sum("n").alias("m"), F.map_from_entries(F.collect_list(F.struct("cell", "n"))).alias("by")
    )  # at most CELLS + 1 cells a stratum
    at = per.select("encoding", "length_class", "m", "by", F.explode(F.sequence(F.lit(0), F.lit(CELLS))).alias("cell"))
    smaller = F.aggregate(
        F.sequence(F.col("cell"), F.lit(CELLS)), F.lit(0).cast("bigint"), lambda acc, c: acc + F.coalesce(F.try_element_at("by", c), F.lit(0))
    )
    passes = F.pow(F.lit(10.0), -F.col("cell") / CELLS_PER_DECADE) * F.col("m") <= level * smaller
    return at.where(passes & (smaller > 0)).groupBy("encoding", "length_class").agg(F.min("cell").alias("cut"))


def _named(rank: int, kind: str, span: Column) -> Column:
    return F.struct(span["start"].alias("start"), F.lit(rank).alias("rank"), span["end"].alias("end"), F.lit(kind).alias("kind"))


def scan(
    docs: DataFrame, level: float = 0.01, min_bits: float = 80.0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, base (array of start, end, kind) and added (the same, kind ``random``) for every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(F.col(doc_id).alias("_id"), body.alias("_body"))
    columns = {f"_{kind}": find_spans(F.col("_body"), *rest) for kind, *rest in BASE}
    columns["_run"] = find_spans(F.col("_body"), RUN, 1, MIN_RUN, RUN)
    found = found.withColumns(columns)
    base = F.concat(*[F.transform(f"_{kind}", partial(_named, i, kind)) for i, (kind, *_) in enumerate(BASE)])
    own = F.filter(
        "_run", lambda r: ~F.exists("_base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
    )
    narrow = found.select("_id", F.monotonically_increasing_id().alias("_row"), F.array_sort(base).alias("_base"), "_run")
    rows = stage(narrow.select("_id", "_row", "_base", own.alias("_run")), "secret-spans")
    runs = rows.where("size(_run) > 0").select("_row", F.explode("_run").alias("_r")).select("_row", "_r.*")
    tested = stage(randomness(runs).drop("token"), "randomness")
    cuts = _dismissed(tested, level)
    kept = tested.select("*", _stratum()[1]).join(cuts, ["encoding", "length_class"], "left")
    bits = F.col("length") * F.log2("alphabet")
    structured = F.floor(-F.log10("p") * CELLS_PER_DECADE) >= F.col("cut")
    kept = kept.where(~F.coalesce(structured, F.lit(False)) & (bits >= min_bits))
    span = F.struct("start", F.lit(len(BASE)).alias("rank"), "end", F.lit("random").alias("kind"))
    added = kept.groupBy("_row").agg(F.array_sort(F.collect_list(span)).alias("added")).withColumnRenamed("_row", "_k")
    out = rows.join(added, F.col("_row") == F.col("_k"), "left")
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return out.select(F.col("_id").alias(doc_id), F.col("_base").alias("base"), F.coalesce("added", none).alias("added"))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of spans in order, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))),
        ",",
    )
