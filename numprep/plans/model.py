"""Fit once, then scale and restore: the core of the package.

``fit`` runs one aggregate over one scan and brings a single row to the driver. ``transform`` and
``inverse_transform`` run nothing: they return projections in which the fitted numbers are literals, so any
later filter, join or write is planned together with them, and no row is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numprep.functions import (
    clip,
    compiled_apart,
    is_number_text,
    outside,
    parse_number,
    round_places,
    write_number,
)
from numprep.plans.spec import ColumnSpec, load_specs

# The messages and suffixes users of the inverse already match on.
REJECTED = "out of range [0,1]"
OUT_OF_RANGE = "Out of range"
DATA, VALID, ERROR = "data", "valid", "error"

PARSE_ERROR = "parse error"
OVERFLOW = "does not fit"

# Defaults of a column without any value.
_EMPTY_MIN, _EMPTY_MAX = 0.0, 1.0

PARAMS_SCHEMA = T.StructType(
    [
        T.StructField("column_name", T.StringType(), False),
        T.StructField("source_type", T.StringType(), False),
        T.StructField("prefix", T.StringType(), False),
        T.StructField("suffix", T.StringType(), False),
        T.StructField("strict_affix", T.BooleanType(), False),
        T.StructField("rounding", T.IntegerType(), True),
        T.StructField("min_val", T.DoubleType(), True),
        T.StructField("max_val", T.DoubleType(), True),
        T.StructField("clip_oor", T.BooleanType(), False),
        T.StructField("clip", T.BooleanType(), False),
        T.StructField("reject", T.BooleanType(), False),
        T.StructField("norm_min", T.DoubleType(), False),
        T.StructField("norm_max", T.DoubleType(), False),
        T.StructField("norm_scale", T.DoubleType(), False),
    ]
)


def quoted(name: str) -> Column:
    """Column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class FittedColumn:
    """Fitted numbers of one column and the expressions made of them."""

    column_name: str
    source_type: str
    prefix: str
    suffix: str
    strict_affix: bool
    rounding: int | None
    min_val: float | None
    max_val: float | None
    clip_oor: bool
    clip: bool
    reject: bool
    norm_min: float
    norm_max: float
    norm_scale: float

    @property
    def data_type(self) -> T.DataType:
        return T.DataType.fromDDL(self.source_type)

    def parse(self, column: Column, data_type: T.DataType | None = None) -> Column:
        """Number held by the column, before any clipping."""
        return parse_number(column, data_type or self.data_type, self.prefix, self.suffix, self.strict_affix)

    def unreadable(self, column: Column, data_type: T.DataType | None = None) -> Column:
        """True for text that is present but is no number."""
        if not isinstance(data_type or self.data_type, T.StringType):
            return F.lit(False)
        return F.coalesce(~is_number_text(column, self.prefix, self.suffix, self.strict_affix), F.lit(False))

    def convert(self, column: Column, data_type: T.DataType | None = None) -> Column:
        """Stored form to number, clamped to the bounds if the column is set so."""
        number = self.parse(column, data_type)
        return clip(number, self.min_val, self.max_val) if self.clip_oor else number

    def normalize(self, number: Column) -> Column:
        """Converted number to the [0, 1] scale."""
        if self.clip:
            number = clip(number, self.norm_min, self.norm_max)
        scaled = (number - F.lit(self.norm_min)) / F.lit(self.norm_scale)
        if not (math.isfinite(self.norm_min) and math.isfinite(self.norm_scale)):
            scaled = F.nullif(scaled, F.lit(math.nan))
        return scaled

    def scale(self, number: Column) -> Column:
        """``normalize(convert(...))`` on a parsed number, with one clamp where one is enough."""
        if self.clip_oor and not (self.clip and self._fitted_range_is_inside()):
            number = clip(number, self.min_val, self.max_val)
        return self.normalize(number)

    def _fitted_range_is_inside(self) -> bool:
        low = -math.inf if self.min_val is None else self.min_val
        high = math.inf if self.max_val is None else self.max_val
        return low <= self.norm_min <= self.norm_max <= high

    def unscale(self, scaled: Column) -> Column:
        """Number in original units, from a value on the [0, 1] scale."""
        if self.clip:
            scaled = clip(scaled, 0.0, 1.0)
        return scaled * F.lit(self.norm_scale) + F.lit(self.norm_min)

    def rejected(self, scaled: Column) -> Column | None:
        """Condition for input beyond [0, 1]. Clamped input cannot be beyond."""
        return outside(scaled, 0.0, 1.0) if self.reject and not self.clip else None

    def out_of_range(self, number: Column) -> Column | None:
        """Condition for a number beyond the bounds, tested before rounding."""
        return None if self.clip_oor else outside(number, self.min_val, self.max_val)

    def settle(self, number: Column) -> Column:
        """Clamped if set so, and rounded."""
        if self.clip_oor:
            number = clip(number, self.min_val, self.max_val)
        return round_places(number, self.rounding)

    def write(self, number: Column) -> Column:
        """Settled number in the stored form of the column."""
        return write_number(number, self.data_type, self.prefix, self.suffix, self.rounding)

    def inverse_normalize(self, scaled: Column) -> Column:
        """Struct of ``data`` (number), ``valid`` and ``error``."""
        return _checked(self.unscale(scaled), [(self.rejected(scaled), REJECTED)])

    def inverse_convert(self, number: Column) -> Column:
        """Struct of ``data`` (stored form), ``valid`` and ``error``."""
        settled = self.settle(number)
        return _checked(self.write(settled), [(self.out_of_range(number), OUT_OF_RANGE), (self.lost(settled), OVERFLOW)])

    def lost(self, settled: Column) -> Column | None:
        """Condition for a settled number that the stored type cannot hold. Text and doubles hold any."""
        if isinstance(self.data_type, (T.StringType, T.DoubleType)):
            return None
        return settled.isNotNull() & self.write(settled).isNull()


def _checked(value: Column, problems: Sequence[tuple[Column | None, str]]) -> Column:
    """Struct of the value, NULL where there is a problem, and the first problem's message."""
    known = [(broken, message) for broken, message in problems if broken is not None]
    if not known:
        return F.struct(compiled_apart(value).alias(DATA), F.lit(True).alias(VALID), F.lit("").alias(ERROR))
    error = F.when(known[0][0], F.lit(known[0][1]))
    for broken, message in known[1:]:
        error = error.when(broken, F.lit(message))
    error = error.otherwise(F.lit(""))
    return F.struct(
        compiled_apart(F.when(error == "", value)).alias(DATA), (error == "").alias(VALID), error.alias(ERROR)
    )


@dataclass(frozen=True)
class FittedModel:
    """Fitted columns, in configuration order."""

    columns: tuple[FittedColumn, ...]

    def __getitem__(self, name: str) -> FittedColumn:
        for fitted in self.columns:
            if fitted.column_name == name:
                return fitted
        raise KeyError(name)

    def transform(self, df: DataFrame, flags: bool = False, on_error: str = "null") -> DataFrame:
        """Replace every fitted column by its scaled value; other columns and the order stay.

        ``flags`` adds ``<c>_valid`` and ``<c>_error`` behind each. Text that is no number gives NULL, or with
        ``on_error="raise"`` fails the query.
        """
        _check_on_error(on_error)
        types = column_types(df, self.columns)
        # The parsed number is used several times below. As a column of its own it is computed once.
        parsed, outputs = [], {}
        for i, fitted in enumerate(self.columns):
            name, data_type = fitted.column_name, types[fitted.column_name]
            source, work = quoted(name), f"__parsed_{i}"
            number = fitted.parse(source, data_type)
            if on_error == "raise" and isinstance(data_type, T.StringType):
                complaint = F.concat(F.lit(f"{PARSE_ERROR} in {name}: "), source)
                number = F.when(fitted.unreadable(source, data_type), F.raise_error(complaint)).otherwise(number)
            parsed.append(number.alias(work))
            outputs[name] = [fitted.scale(F.col(work)).alias(name)]
            if flags:
                bad = source.isNotNull() & F.col(work).isNull()
                if not isinstance(data_type, T.StringType):
                    bad = F.lit(False)
                outputs[name] += [
                    (~bad).alias(f"{name}_{VALID}"),
                    F.when(bad, F.lit(PARSE_ERROR)).otherwise(F.lit("")).alias(f"{name}_{ERROR}"),
                ]
        return df.select("*", *parsed).select(*_in_place(df, outputs))

    def inverse_transform(self, df: DataFrame, flags: bool = False) -> DataFrame:
        """Replace every fitted column by its value in original units, type and text form.

        ``flags`` adds ``<c>_valid`` and ``<c>_error`` behind each. Invalid values are NULL. A value beyond
        [0, 1] is reported before one beyond the bounds, that before one the stored type cannot hold, and an error
        ``transform`` has flagged before all.
        """
        types = column_types(df, self.columns)
        # Each step's result is used several times by the next. As columns of their own they are computed once.
        numbers, settled, outputs = [], [], {}
        for i, fitted in enumerate(self.columns):
            name = fitted.column_name
            source = parse_number(quoted(name), types[name])
            number, work, problem = f"__number_{i}", f"__settled_{i}", f"__problem_{i}"
            numbers.append(fitted.unscale(source).alias(number))
            cases = []
            if flags and f"{name}_{VALID}" in types and f"{name}_{ERROR}" in types:
                earlier = quoted(f"{name}_{ERROR}")
                cases.append((earlier != "", earlier))
            rejected = fitted.rejected(source)
            if rejected is not None:
                cases.append((rejected, F.lit(REJECTED)))
            beyond = fitted.out_of_range(F.col(number))
            if beyond is not None:
                cases.append((beyond, F.lit(OUT_OF_RANGE)))
            lost = fitted.lost(fitted.settle(F.col(number)))
            if lost is not None:
                cases.append((lost, F.lit(OVERFLOW)))
            settled.append(fitted.settle(F.col(number)).alias(work))
            value = fitted.write(F.col(work))
            if not cases:
                outputs[name] = [compiled_apart(value).alias(name)]
                if flags:
                    outputs[name] += [F.lit(True).alias(f"{name}_{VALID}"), F.lit("").alias(f"{name}_{ERROR}")]
                continue
            found = F.when(*cases[0])
            for case in cases[1:]:
                found = found.when(*case)
            settled.append(found.alias(problem))
            ok = F.col(problem).isNull()
            outputs[name] = [compiled_apart(F.when(ok, value)).alias(name)]
            if flags:
                outputs[name] += [
                    ok.alias(f"{name}_{VALID}"),
                    F.coalesce(F.col(problem), F.lit("")).alias(f"{name}_{ERROR}"),
                ]
        restored = df.select("*", *numbers).select("*", *settled)
        return restored.select(*_in_place(df, outputs))

    def merge(self, other: FittedModel) -> FittedModel:
        """Both models' columns, for columns that were fitted apart."""
        mine = {fitted.column_name for fitted in self.columns}
        twice = [fitted.column_name for fitted in other.columns if fitted.column_name in mine]
        if twice:
            raise ValueError(f"columns fitted twice: {', '.join(twice)}")
        return FittedModel(self.columns + other.columns)

    def params(self, spark: SparkSession) -> DataFrame:
        """Fitted parameters, one row per column."""
        return spark.createDataFrame([tuple(asdict(fitted).values()) for fitted in self.columns], PARAMS_SCHEMA)

    def save(self, spark: SparkSession, path: str, file_format: str = "json", mode: str = "errorifexists") -> None:
        """Write the parameters as a table, one row per column."""
        self.params(spark).coalesce(1).write.format(file_format).mode(mode).save(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, file_format: str = "json") -> FittedModel:
        """Read parameters written by ``save``. The table has one row per column and nothing else."""
        return cls.from_params(spark.read.schema(PARAMS_SCHEMA).format(file_format).load(path))

    @classmethod
    def from_params(cls, params: DataFrame) -> FittedModel:
        """Model from a parameter table, such as several saved ones put together."""
        rows = params.select(*PARAMS_SCHEMA.fieldNames()).collect()
        model = cls(())
        for row in rows:
            model = model.merge(cls((FittedColumn(**row.asDict()),)))
        return model


def _in_place(df: DataFrame, outputs: Mapping[str, list[Column]]) -> list[Column]:
    """The table's columns, with the outputs of a column where it was. New flags take the place of old ones."""
    flags = {f"{name}_{flag}" for name, columns in outputs.items() if len(columns) > 1 for flag in (VALID, ERROR)}
    selected = []
    for name in df.columns:
        if name in outputs:
            selected += outputs[name]
        elif name not in flags:
            selected.append(quoted(name))
    return selected


def column_types(df: DataFrame, wanted: Iterable[ColumnSpec | FittedColumn]) -> dict[str, T.DataType]:
    """Types of all columns, after a check that the wanted ones are text or numbers."""
    types = {field.name: field.dataType for field in df.schema.fields}
    for item in wanted:
        name = item.column_name if isinstance(item, FittedColumn) else item.column
        if name not in types:
            raise ValueError(f"no column {name!r} in the table")
        if not isinstance(types[name], (T.StringType, T.NumericType)):
            raise ValueError(f"column {name!r} is {types[name].simpleString()}, neither text nor a number")
    return types


def _check_on_error(on_error: str) -> None:
    if on_error not in ("null", "raise"):
        raise ValueError("on_error is 'null' or 'raise'")


def fit(
    df: DataFrame,
    config: Mapping[str, Mapping] | Iterable[ColumnSpec] | str | Path,
    columns: Iterable[str] | None = None,
    on_error: str = "null",
) -> FittedModel:
    """Learn every column's range in one pass.

    Clamping keeps order, so the minimum of the clamped values is the clamped minimum. One aggregate over the
    raw values therefore serves the empirical bounds and the ranges after clamping alike.
    """
    _check_on_error(on_error)
    specs = load_specs(config, columns)
    if not specs:
        raise ValueError("no columns to fit")
    types = column_types(df, specs)
    parsed, measures = [], []
    for i, spec in enumerate(specs):
        source, data_type = quoted(spec.column), types[spec.column]
        affixes = (spec.prefix, spec.suffix, spec.strict_affix)
        parsed.append(parse_number(source, data_type, *affixes).alias(f"v{i}"))
        measures += [F.min(f"v{i}").alias(f"min{i}"), F.max(f"v{i}").alias(f"max{i}")]
        if on_error == "raise":
            parsed.append((source.isNotNull() if isinstance(data_type, T.StringType) else F.lit(False)).alias(f"s{i}"))
            measures.append(F.count_if(F.col(f"s{i}") & F.col(f"v{i}").isNull()).alias(f"bad{i}"))
    found = df.select(*parsed).agg(*measures).first()
    if on_error == "raise":
        bad = {spec.column: found[f"bad{i}"] for i, spec in enumerate(specs) if found[f"bad{i}"]}
        if bad:
            raise ValueError(f"{PARSE_ERROR}: {bad}")
    return FittedModel(
        tuple(
            _fitted(spec, types[spec.column].simpleString(), found[f"min{i}"], found[f"max{i}"])
            for i, spec in enumerate(specs)
        )
    )


def _fitted(spec: ColumnSpec, source_type: str, low: float | None, high: float | None) -> FittedColumn:
    min_val = low if spec.min_val is True else spec.fixed_min
    max_val = high if spec.max_val is True else spec.fixed_max
    if low is None:
        norm_min, norm_max = _EMPTY_MIN, _EMPTY_MAX
    elif spec.clip_oor:
        norm_min, norm_max = _clamped(low, min_val, max_val), _clamped(high, min_val, max_val)
    else:
        norm_min, norm_max = low, high
    return FittedColumn(
        column_name=spec.column,
        source_type=source_type,
        prefix=spec.prefix,
        suffix=spec.suffix,
        strict_affix=spec.strict_affix,
        rounding=spec.rounding,
        min_val=min_val,
        max_val=max_val,
        clip_oor=spec.clip_oor,
        clip=spec.clip,
        reject=spec.reject,
        norm_min=norm_min,
        norm_max=norm_max,
        norm_scale=(norm_max - norm_min) or 1.0,
    )


def _clamped(value: float, low: float | None, high: float | None) -> float:
    if low is not None and high is not None and low > high:
        low, high = high, low
    if low is not None and value < low:
        return low
    if high is not None and value > high:
        return high
    return value
