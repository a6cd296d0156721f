"""Column naming, numeric coercion, feature selection, validation of incoming rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns removed before training (ids, geography, leakage) and the target.
DROP_COLUMNS = [
    "customerid", "count", "country", "state", "city", "zip_code", "lat_long", "latitude",
    "longitude", "churn_label", "churn_reason", "cltv", "churn_score",
]
TARGET = "churn_value"

# Decimal or scientific number with optional sign and surrounding blanks; 'inf' / 'infinity'
# also parse (as in pandas' to_numeric). 'nan' parses to missing. Spark's cast alone would
# also accept Java suffixes such as '5d', which pandas rejects.
NUMERIC_PATTERN = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip names, spaces -> '_', lower case."""
    return df.toDF(*[c.strip().replace(" ", "_").lower() for c in df.columns])


def parse_numeric(col: str | Column) -> Column:
    """String -> double; anything that is not a number becomes null (never an error)."""
    c = F.col(col) if isinstance(col, str) else col
    return _try_double(F.trim(c.cast("string")))


def _try_double(s: Column) -> Column:
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))


def coerce_numeric(df: DataFrame, col: str, fill: float | None = 0.0) -> DataFrame:
    """Replace ``col`` by its parsed double; unparsable values become null, then ``fill``."""
    v = _try_double(F.trim(F.col(col).cast("string")))
    if fill is not None:
        v = F.coalesce(v, F.lit(float(fill)))
    return df.withColumn(col, v)


def bad_numeric_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of ``col`` that do not parse as numbers, with counts."""
    s = F.trim(F.col(col).cast("string"))
    return (df.where(F.col(col).isNotNull() & _try_double(s).isNull())
            .groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")))


def coercion_report(df: DataFrame, col: str) -> DataFrame:
    """Null counts before coercion, after coercion and after filling with 0 (one row)."""
    parsed = _try_double(F.trim(F.col(col).cast("string")))
    return df.agg(
        F.count_if(F.col(col).isNull()).alias("nulls_before"),
        F.count_if(parsed.isNull()).alias("nulls_after_coerce"),
        F.count_if(F.coalesce(parsed, F.lit(0.0)).isNull()).alias("nulls_after_fill"))


def zero_tenure_audit(df: DataFrame, tenure_col: str = "tenure_months",
                      charges_col: str = "total_charges") -> DataFrame:
    """Customers with tenure 0, and how many of them have no parsable charge (one row)."""
    zero = F.col(tenure_col) == 0
    parsed = _try_double(F.trim(F.col(charges_col).cast("string")))
    return df.agg(F.count_if(zero).alias("n_zero_tenure"),
                  F.count_if(zero & parsed.isNull()).alias("n_zero_tenure_null_charges"))


def select_features(df: DataFrame, target: str = TARGET, extra_drop: tuple[str, ...] = ("cnt",),
                    label: str = "label") -> DataFrame:
    """Drop id / geography / leakage columns and rename the target to ``label``.

    X is every remaining column; y is ``label`` (the split into two frames is a select).
    """
    if target not in df.columns and "Churn Value" in df.columns:
        df = df.withColumnRenamed("Churn Value", target)
    return df.drop(*DROP_COLUMNS, *extra_drop).withColumnRenamed(target, label)


def feature_types(df: DataFrame, exclude: tuple[str, ...] = ("label",)) -> tuple[list[str], list[str]]:
    """(categorical, numeric) column names from the schema."""
    cat, num = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType):
            cat.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            num.append(f.name)
    return cat, num


def valid_category_check(batch: DataFrame, domains: DataFrame, columns: list[str],
                         id_col: str) -> tuple[DataFrame, DataFrame]:
    """Split a batch by the learned category domains.

    ``domains`` is (column, value) as learned from the training table. Returns
    (valid rows, rejects(id, column, value, reason)).
    """
    long = batch.select(id_col, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("_kv")).select(id_col, "_kv.column", "_kv.value")
    bad = long.join(domains, ["column", "value"], "left_anti")
    rejects = bad.select(id_col, "column", "value",
                         F.concat(F.lit("invalid value for "), F.col("column")).alias("reason"))
    valid = batch.join(bad.select(id_col).distinct(), id_col, "left_anti")
    return valid, rejects


def category_domains(df: DataFrame, columns: list[str]) -> DataFrame:
    """Learned domain (column, value) of each categorical column."""
    return (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("_kv")).select("_kv.column", "_kv.value").distinct())


def schema_checks(df: DataFrame, required: list[str], checks: dict[str, Column]) -> DataFrame:
    """Add ``reject_reasons`` (array of failed rule names) and ``is_valid``.

    ``required`` columns must be non-null; ``checks`` maps a rule name to a boolean column
    that must be true. Nulls in a rule count as failures.
    """
    reasons = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    reasons += [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in checks.items()]
    arr = F.filter(F.array(*reasons), lambda x: x.isNotNull()) if reasons else F.array().cast("array<string>")
    return df.withColumn("reject_reasons", arr).withColumn("is_valid", F.size("reject_reasons") == 0)


def non_numeric_properties(props: DataFrame, property_col: str = "property") -> DataFrame:
    """Properties whose name is not a number, with row counts."""
    return (props.where(~F.col(property_col).rlike(r"^[0-9]+$"))
            .groupBy(property_col).agg(F.count(F.lit(1)).alias("n")))


def positive_eval_pairs(samples: DataFrame, label_col: str = "label") -> DataFrame:
    """All label = 1 rows: the pairs that ranking metrics are computed over."""
    return samples.where(F.col(label_col) == 1)


def predict_class(df: DataFrame, threshold: float = 0.5, proba_col: str = "y_proba",
                  out_col: str = "y_pred", inclusive: bool = False) -> DataFrame:
    """0/1 from a probability: ``p > thr`` (MLP predict) or ``p >= thr`` (threshold sweep)."""
    cond = F.col(proba_col) >= threshold if inclusive else F.col(proba_col) > threshold
    return df.withColumn(out_col, cond.cast("int"))
