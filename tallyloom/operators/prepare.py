"""Column preparation: prefixes, casts, remaps and the ordered repair rules of each block."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.columns import as_column
from tallyloom.operators.ranking import exact_quantiles
from tallyloom.session import cut_lineage


def prefix_columns(df: DataFrame, prefix: str, exceptions: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in df.columns if c not in exceptions})


def suffix_columns(df: DataFrame, suffix: str, exceptions: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c not in exceptions})


def split_by_type(df: DataFrame, leave_out: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Names of the numeric and of the other columns."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in leave_out]
    other = [c for c in df.columns if c not in numeric and c not in leave_out]
    return numeric, other


def cast_by_type(df: DataFrame, categorical: Sequence[str] = ()) -> DataFrame:
    """Numbers to double, everything else (and the named ones) to text, in one projection."""
    numeric, _ = split_by_type(df, categorical)
    return df.select(*[F.col(c).cast("double" if c in numeric else "string").alias(c) for c in df.columns])


def remap(column: Column | str, mapping: Mapping) -> Column:
    """Literal value map; unmapped values become NULL."""
    column = as_column(column)
    out = None
    for value, label in mapping.items():
        out = (F if out is None else out).when(column == F.lit(value), F.lit(label))
    return out


def cast_fill(df: DataFrame, fills: Mapping[str, float]) -> DataFrame:
    """Cast the named columns to double and fill NULLs (and NaNs) with the column's sentinel, in one projection."""

    def fixed(c: str) -> Column:
        if c not in fills:
            return F.col(c)
        value = F.col(c).try_cast("double")
        return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(float(fills[c]))).alias(c)

    return df.select(*[fixed(c) for c in df.columns])


def tenure_rules(df: DataFrame, missing: float) -> DataFrame:
    """Repairs in order: missing -> recency; negative -> first purchase in the window;
    registration before the first buy -> first purchase in the window; then fill.
    """
    buy, reg, listing, sale = (f"days_from_{n}" for n in ("first_buy", "registration", "first_listing", "first_sale"))
    out = df.withColumns({buy: F.coalesce(buy, "recency"), reg: F.coalesce(reg, "recency")})
    out = out.withColumn(buy, F.when(F.col(buy) < 0, F.col("first_in_window")).otherwise(F.col(buy)))
    out = out.withColumn(reg, F.when(F.col(reg) < 0, F.col(buy)).otherwise(F.col(reg)))
    out = out.withColumn(listing, F.when(F.col(listing) < 0, missing).otherwise(F.col(listing)))
    out = out.withColumn(reg, F.when(F.col(reg) < F.col(buy), F.col("first_in_window")).otherwise(F.col(reg)))
    return cast_fill(out, dict.fromkeys([buy, reg, listing, sale], missing))


def prepaid_rules(df: DataFrame, missing: float) -> DataFrame:
    """Recency is at least the activation; negatives are missing; active flag (0 when never activated)."""
    recency, activation = F.col("ppd_recency"), F.col("ppd_first_activation")
    out = df.withColumn("ppd_recency", F.when(recency < activation, activation).otherwise(recency))
    out = out.withColumns(
        {
            "ppd_recency": F.when(F.col("ppd_recency") >= 0, F.col("ppd_recency")),
            "ppd_active": F.coalesce((activation >= 0).cast("double"), F.lit(0.0)),
            "ppd_first_activation": F.when(activation >= 0, activation),
        }
    )
    money = [c for c in ("has_prepaid", "ppd_sum_money", "ppd_mean_money", "ppd_min_money", "ppd_max_money") if c in df.columns]
    return cast_fill(out, {**dict.fromkeys(money, 0.0), "ppd_recency": missing, "ppd_first_activation": missing})


# Accepted texts of the registry, and statuses that count as married.
GENDERS = ["MASCULINO", "FEMININO"]
PERSON_TYPES = ["person", "company"]
MARRIED = {"UNIAO ESTAVEL": "CASADO(A)", "DIVORCIADO(A)": "CASADO(A)", "VIUVO(A)": "CASADO(A)"}
CIVIL_STATUSES = ["CASADO(A)", "SOLTEIRO(A)"]


def registry_rules(df: DataFrame, missing: float, unknown: str = "NA") -> DataFrame:
    """Allow-lists, trimmed text, ages 1 to 100, rare civil statuses merged."""

    def allowed(c: Column, values: Sequence[str]) -> Column:
        return F.when(c.isin(list(values)), c).otherwise(unknown)

    status = F.trim("civil_status")
    for old, new in MARRIED.items():
        status = F.when(status == old, new).otherwise(status)
    age = F.col("age").cast("double")
    return df.withColumns(
        {
            "data_type": allowed(F.col("data_type"), PERSON_TYPES), "gender": allowed(F.trim("gender"), GENDERS),
            "age": F.when((age <= 0) | (age > 100), missing).otherwise(age), "civil_status": allowed(status, CIVIL_STATUSES),
        }
    )


def location_rules(df: DataFrame, states: DataFrame, site: str | None = None, other: str = "other_state") -> DataFrame:
    """Keep the known states (per site when given), everything else becomes `other`."""
    keys = ["location"] if site is None else [site, "location"]
    known = states.select(*keys).distinct().withColumn("__known", F.lit(True))
    return df.join(known, keys, "left").withColumn(
        "location", F.when(F.col("__known"), F.col("location")).otherwise(other)
    ).select(*df.columns)


def reinstall_flag(df: DataFrame, missing: float) -> DataFrame:
    """Fill the install days and flag customers whose last and first install differ."""
    out = cast_fill(df, {"days_last_install": missing, "days_first_install": missing}).na.fill({"device": "OTHER_DEVICE"})
    return out.withColumn("reinstalled", (F.col("days_last_install") < F.col("days_first_install")).cast("double"))


def max_plus_one(df: DataFrame, column: str) -> DataFrame:
    """Missing recency becomes the largest recency plus one."""
    return df.withColumn(column, F.coalesce(F.col(column), df.agg(F.max(column) + 1).scalar()))


def draw_missing(df: DataFrame, column: str, key: str, seed: str = "s", cells: int = 1024) -> DataFrame:
    """Fill a missing category by a draw from the observed distribution, by a hash of the key.

    A category's interval of [0, 1) is its running share by name. Rows without a category meet the intervals cell by cell,
    an equality join, so the number of categories is not bounded.
    """
    from tallyloom.operators.sampling import unit_hash

    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    upto = running_by_range(counts, "v", F.sum("n"), "__upto")
    total = counts.agg(F.sum("n")).scalar()
    shares = upto.select("v", ((F.col("__upto") - F.col("n")) / total).alias("start"), (F.col("__upto") / total).alias("end"))
    cell = lambda c: F.least(F.floor(c * cells), F.lit(cells - 1))
    spans = shares.select("v", "start", "end", F.explode(F.sequence(cell(F.col("start")), cell(F.col("end")))).alias("__cell"))
    rows = df.withColumn("__u", F.when(F.col(column).isNull(), unit_hash(key, seed))).withColumn("__cell", F.when(F.col("__u").isNotNull(), cell(F.col("__u"))))
    hit = (rows["__cell"] == spans["__cell"]) & (rows["__u"] >= spans["start"]) & (rows["__u"] < spans["end"])
    return rows.join(spans, hit, "left").select(*[F.coalesce(column, "v").alias(column) if c == column else F.col(c) for c in df.columns])


def median_by_group(df: DataFrame, columns: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Fill missing numbers with the approximate median of the row's group, else of all rows."""
    medians = df.groupBy(*group).agg(*[F.percentile_approx(c, 0.5).alias(f"__g_{c}") for c in columns])
    whole = df.agg(F.struct(*[F.percentile_approx(c, 0.5).alias(c) for c in columns])).scalar()
    out = df.join(medians, list(group), "left").withColumn("__all", whole)
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"__g_{c}"), F.col("__all").getField(c)) for c in columns}).select(*df.columns)


def forest_impute(df: DataFrame, columns: Sequence[str], key: str, rounds: int = 3, trees: int = 3, depth: int = 6, seed: str = "forest") -> DataFrame:
    """Fill missing numbers column by column with a forest on the other columns, round after round.

    Missing values start as the mean of their column. In a round the columns, those with the fewest gaps first, are each predicted
    from all others, learnt where they are known; trees see rows as often as a Poisson draw by a hash of key, tree and
    column says, so reruns draw alike. It stops when the summed squared change of the filled values, relative to the sum of their
    squares, grows for the first time, and the round before is the result, or after `rounds` rounds. Known values stay; a column
    without any known value stays null. One row for each key.
    """
    from tallyloom.operators.sampling import unit_hash

    names = list(columns)
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(names)], *[F.count_if(F.col(c).isNull()).alias(f"g{i}") for i, c in enumerate(names)]).first()
    usable = [i for i in range(len(names)) if stats[f"m{i}"] is not None]
    gaps = sorted((i for i in usable if stats[f"g{i}"]), key=lambda i: (stats[f"g{i}"], names[i]))
    # Cumulative probabilities of a Poisson distribution of mean one: a hash below the first is out, below the second in once, ...
    border, weights = 0.0, []
    for n in range(5):
        border += math.exp(-1) / math.factorial(n)
        weights.append(border)

    def times(i: int, tree: int) -> Column:
        draw = unit_hash(key, f"{seed}:{i}:{tree}")
        return sum((F.when(draw >= w, 1).otherwise(0) for w in weights), F.lit(0)).cast("byte")

    # A draw is the same in every round: it is hashed once and kept with the row.
    rows = df.select(
        key, *[F.coalesce(F.col(names[i]).cast("double"), F.lit(stats[f"m{i}"])).alias(f"x{i}") for i in usable], *[F.col(names[i]).isNull().alias(f"gap{i}") for i in gaps],
        *[times(i, tree).alias(f"times{i}_{tree}") for i in gaps for tree in range(trees if len(usable) > 1 else 0)],
    )
    rows = cut_lineage(rows)
    last = math.inf
    for turn in range(rounds if len(usable) > 1 else 0):
        # The values of the round before stay beside the new ones, so that the change needs no join.
        fitted = rows.withColumns({f"old{i}": F.col(f"x{i}") for i in gaps})
        for i in gaps:
            assembler = VectorAssembler(inputCols=[f"x{j}" for j in usable if j != i], outputCol="__features")
            seen = assembler.transform(fitted)
            forest = []
            for tree in range(trees):
                learner = DecisionTreeRegressor(featuresCol="__features", labelCol=f"x{i}", weightCol="__times", maxDepth=depth, predictionCol=f"__p{tree}", seed=17)
                drawn = seen.where(f"not gap{i} and times{i}_{tree} > 0").select("__features", f"x{i}", F.col(f"times{i}_{tree}").cast("double").alias("__times"))
                forest.append(learner.fit(drawn))
            for model in forest:
                seen = model.transform(seen)
            mean = sum((F.col(f"__p{t}") for t in range(trees)), F.lit(0.0)) / trees
            fitted = cut_lineage(seen.withColumn(f"x{i}", F.when(F.col(f"gap{i}"), mean).otherwise(F.col(f"x{i}"))).select(*fitted.columns))
        change = fitted.agg(F.sum(sum((F.when(F.col(f"gap{i}"), (F.col(f"x{i}") - F.col(f"old{i}")) ** 2).otherwise(0.0) for i in gaps), F.lit(0.0))).alias("c"),
                           F.sum(sum((F.when(F.col(f"gap{i}"), F.col(f"x{i}") ** 2).otherwise(0.0) for i in gaps), F.lit(0.0))).alias("s")).first() if gaps else None
        if change is None or not change["s"]:
            break
        if change["c"] / change["s"] > last:
            break
        last, rows = change["c"] / change["s"], fitted.drop(*[f"old{i}" for i in gaps])
        if not last:
            break
    filled = rows.select(key, *[F.col(f"x{i}").alias(f"__x{i}") for i in usable])
    number = {names[i]: i for i in usable}
    return df.join(filled, key).select(*[F.coalesce(F.col(c).cast("double"), F.col(f"__x{number[c]}")).alias(c) if c in number else F.col(c) for c in df.columns])


def clip_upper(df: DataFrame, columns: Sequence[str], q: float = 0.95, approximate: bool = False) -> DataFrame:
    """Values above the q-quantile become the quantile, for all columns in one pass.

    The quantile is exact and interpolated; `approximate` takes it from a sketch instead.
    """
    if approximate:
        caps = df.agg(F.struct(*[F.percentile_approx(F.col(c).cast("double"), q, 100000).alias(c) for c in columns])).scalar()
    else:
        found = exact_quantiles(df, columns, [q])
        caps = found.agg(F.struct(*[F.max(F.when(F.col("feature") == c, F.col("quantiles")[0])).alias(c) for c in columns])).scalar()
    out = df.withColumn("__caps", caps)
    return out.withColumns(
        {c: F.when(F.col(c) > F.col("__caps").getField(c), F.col("__caps").getField(c)).otherwise(F.col(c).cast("double")) for c in columns}
    ).drop("__caps")


def negative_to(df: DataFrame, columns: Sequence[str], missing: float) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) < 0, missing).otherwise(F.col(c).cast("double")) for c in columns})


def low_activity(df: DataFrame, sends: str, spend: str, limit: int) -> DataFrame:
    """Days with few sends count as days without, and without sends there is no spend."""
    out = df.withColumn(sends, F.when(F.col(sends) > limit, F.col(sends)).otherwise(0))
    return out.withColumn(spend, F.when(F.col(sends) == 0, 0).otherwise(F.col(spend)))


def fit_scale(df: DataFrame, columns: Sequence[str], robust: bool = False) -> DataFrame:
    """Centre and spread per column as one row: mean and population std, or median and IQR."""
    if robust:
        found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])

        def part(c: str) -> Column:
            q = F.max(F.when(F.col("feature") == c, F.col("quantiles")))
            return F.struct(q[1].alias("center"), (q[2] - q[0]).alias("spread")).alias(c)

        return found.agg(F.struct(*[part(c) for c in columns]).alias("scale"))
    values = {c: F.col(c).cast("double") for c in columns}
    return df.agg(F.struct(*[F.struct(F.avg(v).alias("center"), F.stddev_pop(v).alias("spread")).alias(c) for c, v in values.items()]).alias("scale"))


def apply_scale(df: DataFrame, scale: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Apply a fitted scale, also to other rows than it was fitted on; constant columns become 0."""
    out = df.withColumn("__scale", scale.scalar())

    def scaled(c: str) -> Column:
        s = F.col("__scale").getField(c)
        gap = F.col(c).cast("double") - s.getField("center")
        return F.when(s.getField("spread") == 0, gap).otherwise(F.try_divide(gap, s.getField("spread")))

    return out.withColumns({c: scaled(c) for c in columns}).drop("__scale")


def from_dummies(columns: Sequence[str]) -> Column:
    """One-hot columns back to one code, 1 for the first column."""
    return sum((F.col(c) * (i + 1) for i, c in enumerate(columns)), F.lit(0))


def running_by_range(df: DataFrame, column: str, total: Column, out: str) -> DataFrame:
    """Running `total` (a sum or a count) over rows with different values of `column`, in its order.

    Totals run inside the ranges that a range partitioning gives, and the totals of the ranges before (one row per task)
    are added, so no task sees all rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Materialised: ranges and totals must come from one evaluation.
    ranged = cut_lineage(df.repartitionByRange(parts, column).withColumn("__p", F.spark_partition_id()))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("__p").agg(total.alias("__t")).select("__p", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__ahead"))
    inside = total.over(Window.partitionBy("__p").orderBy(column).rowsBetween(Window.unboundedPreceding, 0))
    return ranged.withColumn("__in", inside).join(sizes, "__p").withColumn(out, F.col("__in") + F.col("__ahead")).drop("__p", "__in", "__ahead")


def code_table(df: DataFrame, column: str, at_least: int, out: str = "code") -> DataFrame:
    """Dense codes from 1, by name, of the labels seen at least `at_least` times; one row per label."""
    labels = df.groupBy(column).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= at_least).select(column)
    return running_by_range(labels, column, F.count(F.lit(1)), out).withColumn(out, F.col(out).cast("int"))


def label_codes(df: DataFrame, column: str, at_least: int, out: str = "code") -> DataFrame:
    """Drop labels seen fewer than `at_least` times and give the others dense codes from 1, by name."""
    return df.join(code_table(df, column, at_least, out), column)


def class_weights(df: DataFrame, column: str, out: str = "weight") -> DataFrame:
    """Balanced weights n / (classes * n_class), one row per class."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg((F.sum("n") / F.count(F.lit(1))).alias("x")).scalar()
    return counts.select(column, (whole / F.col("n")).alias(out))
