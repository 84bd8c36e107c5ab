"""Target encoding with variance-based shrinkage, plain and cross-fitted, and population standardisation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onblock.runtime import cut_lineage

FOLDS = 5
BROADCAST_ROWS = 500_000
MOMENTS = ["n", "s", "q"]


def fold_of(key: str, folds: int = FOLDS) -> Column:
    """Fold from a hash of the row key, so it depends on no encoded column."""
    return F.ascii(F.substring(F.md5(F.col(key).cast("string")), 1, 1)) % folds


def _moments(label: Column) -> list[Column]:
    y = label.cast("double")
    return [F.count(y).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q")]


def _shrunk(n, s, q, gn, gs, gq) -> Column:
    """Category mean drawn towards the overall mean: weight n*V / (v + n*V); the overall mean if that is undefined."""
    n, s, q, gn, gs, gq = (F.col(c) if isinstance(c, str) else c for c in (n, s, q, gn, gs, gq))
    mean, overall = F.try_divide(s, n), F.try_divide(gs, gn)
    v = F.try_divide(q, n) - mean * mean
    big_v = F.try_divide(gq, gn) - overall * overall
    weight = F.try_divide(n * big_v, v + n * big_v)
    return F.coalesce(weight * mean + (1 - weight) * overall, overall)


@dataclass(frozen=True)
class TargetEncoding:
    """Label moments per category value and fold for each encoded column, and the moments of all rows.

    A missing value is a category of its own. Keys match null to null, which also keeps null checks from being pushed
    into the shared roll-up, where they would make every column read the training rows again.
    """

    columns: list[str]
    parts: dict[str, DataFrame]
    total: DataFrame
    folds: int

    @staticmethod
    def from_cells(columns: list[str], cells: DataFrame, folds: int) -> TargetEncoding:
        """From label moments per combination of categories and fold."""
        again = [F.sum(m).alias(m) for m in MOMENTS]
        parts = {c: cells.groupBy(F.col(c).alias("value"), "fold").agg(*again) for c in columns}
        return TargetEncoding(columns, parts, cells.groupBy("fold").agg(*again), folds)

    def table(self, column: str) -> DataFrame:
        """`value`, `enc`: one row per category seen in training."""
        sums = self.parts[column].groupBy("value").agg(*[F.sum(m).alias(m) for m in MOMENTS])
        return self._with_total(sums).select("value", _shrunk(*MOMENTS, "_t.n", "_t.s", "_t.q").alias("enc"))

    def fold_table(self, column: str) -> DataFrame:
        """`value`, `fold`, `enc`: the encoding of a category for rows of a fold, learnt on all other folds."""
        part = self.parts[column]
        whole = part.groupBy("value").agg(*[F.sum(m).alias(f"_{m}") for m in MOMENTS])
        by_fold = F.map_from_entries(F.collect_list(F.struct("fold", F.struct(*MOMENTS))))
        held = self.total.agg(by_fold).scalar()
        whole = whole.withColumnRenamed("value", "_w")
        joined = part.join(whole, F.col("value").eqNullSafe(F.col("_w")))
        joined = self._with_total(joined).withColumn("_held", held)
        held_out = F.try_element_at("_held", "fold")
        rest = [F.col(f"_{m}") - F.col(m) for m in MOMENTS]
        rest_total = [F.col(f"_t.{m}") - held_out[m] for m in MOMENTS]
        return joined.select("value", "fold", _shrunk(*rest, *rest_total).alias("enc"))

    def overall(self) -> Column:
        sums = self._sums()
        return F.try_divide(sums["s"], sums["n"])

    def transform(self, df: DataFrame, suffix: str = "_enc") -> DataFrame:
        """Adds the encoding of every column; categories unseen in training get the overall mean."""
        out = df.withColumn("_overall", self.overall())
        for c in self.columns:
            side = self.table(c).select(F.col("value").alias("_v"), F.col("enc").alias("_e"))
            out = out.join(side, F.col(c).eqNullSafe(F.col("_v")), "left")
            out = out.withColumn(f"{c}{suffix}", F.coalesce("_e", "_overall")).drop("_v", "_e")
        return out.drop("_overall")

    def transform_training(self, df: DataFrame, key: str, suffix: str = "_enc") -> DataFrame:
        """Adds encodings learnt without the row's own fold, for the rows the encoding was fitted on."""
        out = df.withColumn("_fold", fold_of(key, self.folds)).withColumn("_overall", self.overall())
        for c in self.columns:
            side = self.fold_table(c).select(F.col("value").alias("_v"), F.col("fold").alias("_f"), F.col("enc").alias("_e"))
            out = out.join(side, F.col(c).eqNullSafe(F.col("_v")) & F.col("_fold").eqNullSafe(F.col("_f")), "left")
            out = out.withColumn(f"{c}{suffix}", F.coalesce("_e", "_overall")).drop("_v", "_f", "_e")
        return out.drop("_overall", "_fold")

    def _sums(self) -> Column:
        """All moments in one subquery, so that every use of it is the same plan."""
        return self.total.agg(F.struct(*[F.sum(m).alias(m) for m in MOMENTS])).scalar()

    def _with_total(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_t", self._sums())


@dataclass(frozen=True)
class SettledEncoding(TargetEncoding):
    """An encoding whose tables are stored; small ones are broadcast after they have been counted."""

    plain: DataFrame | None = None
    mean: float | None = None
    counts: dict[str, int] | None = None

    @staticmethod
    def of(columns: list[str], plain: DataFrame, folded: DataFrame | None, mean: float, folds: int) -> SettledEncoding:
        counts = {row["column"]: row["n"] for row in plain.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        parts = {} if folded is None else {c: folded.filter(F.col("column") == c).drop("column") for c in columns}
        return SettledEncoding(columns, parts, plain, folds, plain, mean, counts)

    def _sized(self, df: DataFrame, column: str, times: int = 1) -> DataFrame:
        small = self.counts.get(column, 0) * times <= BROADCAST_ROWS
        return F.broadcast(df) if small else df

    def table(self, column: str) -> DataFrame:
        return self._sized(self.plain.filter(F.col("column") == column).select("value", "enc"), column)

    def fold_table(self, column: str) -> DataFrame:
        return self._sized(self.parts[column], column, self.folds)

    def overall(self) -> Column:
        return F.lit(self.mean)


def category_cells(train: DataFrame, columns: list[str], label: str, key: str, folds: int = FOLDS) -> DataFrame:
    """Label moments per combination of all categories and fold; every column rolls up from them."""
    return (
        train.filter(F.col(label).isNotNull())
        .groupBy(*columns, fold_of(key, folds).alias("fold"))
        .agg(*_moments(F.col(label)))
    )


def fit_target_encoding(
    train: DataFrame, columns: list[str], label: str, key: str, folds: int = FOLDS
) -> TargetEncoding:
    """A lazy encoding; it reads the training rows once per query."""
    return TargetEncoding.from_cells(columns, category_cells(train, columns, label, key, folds), folds)


def fit_settled_encoding(
    train: DataFrame, columns: list[str], label: str, key: str, folds: int = FOLDS
) -> SettledEncoding:
    """The encoding behind checkpoints: one pass over the training rows, whatever is joined later."""
    cells = cut_lineage(category_cells(train, columns, label, key, folds))
    sums = [F.sum(m).alias(m) for m in MOMENTS]
    named = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])
    by_fold = (
        cells.select("fold", *MOMENTS, F.explode(named).alias("column", "value"))
        .groupBy("column", "value", "fold")
        .agg(*sums)
    )
    # One row per fold, so the overall moments and those without a fold are plain numbers.
    held = {r["fold"]: [float(r[m]) for m in MOMENTS] for r in cells.groupBy("fold").agg(*sums).collect()}
    overall = [sum(part) for part in zip(*held.values())]
    rest_overall = [
        F.element_at(F.create_map(*[x for f, part in held.items() for x in (F.lit(f), F.lit(overall[i] - part[i]))]), F.col("fold"))
        for i in range(len(MOMENTS))
    ]
    value = Window.partitionBy("column", "value")
    whole = by_fold.withColumns({f"_{m}": F.sum(m).over(value) for m in MOMENTS})
    rest = [F.col(f"_{m}") - F.col(m) for m in MOMENTS]
    folded = whole.select("column", "value", "fold", _shrunk(*rest, *rest_overall).alias("enc"))
    plain = by_fold.groupBy("column", "value").agg(*sums)
    plain = plain.select("column", "value", _shrunk(*MOMENTS, *[F.lit(x) for x in overall]).alias("enc"))
    mean = overall[1] / overall[0]
    return SettledEncoding.of(columns, cut_lineage(plain), cut_lineage(folded), mean, folds)


def standardised(df: DataFrame, columns: list[str], suffix: str = "_z") -> DataFrame:
    """Adds (x - mean) / population deviation; columns without spread become 0."""
    stats = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns])
    ).scalar()
    out = df.withColumn("_z", stats)
    return out.withColumns(
        {
            f"{c}{suffix}": F.when(F.col(f"_z.{c}.s") == 0, F.lit(0.0)).otherwise(
                F.try_divide(F.col(c) - F.col(f"_z.{c}.m"), F.col(f"_z.{c}.s"))
            )
            for c in columns
        }
    ).drop("_z")
