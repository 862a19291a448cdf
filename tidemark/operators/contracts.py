"""Table contracts: exact schema, primary key, partitions, order, and evolution by overlays."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The closed set of logical types and their Spark types. ts_ns is kept as a long of nanoseconds.
LOGICAL = {
    "string": T.StringType(), "list_string": T.ArrayType(T.StringType(), False), "boolean": T.BooleanType(), "int64": T.LongType(), "float64": T.DoubleType(),
    "date32": T.DateType(), "timestamp_ns_utc": T.LongType(), "json_string": T.StringType(),
}


class ContractError(ValueError):
    """A table doesn't keep its contract."""


@dataclass(frozen=True)
class TableContract:
    name: str
    version: int
    columns: tuple[tuple[str, str, bool], ...]  # name, logical type, nullable
    primary_key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    rules: tuple[dict, ...] = field(default=())

    def __post_init__(self):
        names = [c for c, _, _ in self.columns]
        if len(set(names)) != len(names):
            raise ContractError("a column stands twice")
        for c, kind, nullable in self.columns:
            if kind not in LOGICAL:
                raise ContractError(f"{c}: unknown type {kind}")
            if nullable and c in self.primary_key:
                raise ContractError(f"{c}: a key column can't be nullable")
        for c in (*self.primary_key, *self.partition_by, *self.sort_by):
            if c not in names:
                raise ContractError(f"{c}: no such column")

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, LOGICAL[k], n) for c, k, n in self.columns])

    def digest(self) -> str:
        import hashlib
        import json

        return hashlib.sha256(json.dumps([self.name, self.version, self.columns, self.primary_key, self.partition_by, self.sort_by, self.rules], sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    def project(self, df: DataFrame) -> DataFrame:
        """Exactly the contract's columns, in order, cast; a cast that fails raises."""
        return df.select(*[F.col(c).cast(LOGICAL[k]).alias(c) for c, k, _ in self.columns])

    def check_schema(self, df: DataFrame) -> DataFrame:
        """df, if names, order and types are the contract's."""
        got, want = [(f.name, f.dataType.simpleString()) for f in df.schema], [(c, LOGICAL[k].simpleString()) for c, k, _ in self.columns]
        if got != want:
            raise ContractError(f"{self.name}: {sorted(set(got) ^ set(want)) or 'column order'}")
        return df

    def violations(self, df: DataFrame) -> DataFrame:
        """One row: rows, nulls in columns that may have none, and rows in excess of the primary key. One shuffle."""
        required = [c for c, _, nullable in self.columns if not nullable]
        groups = df.groupBy(*self.primary_key).agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in required])
        return groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("key_excess"), *[F.coalesce(F.sum(f"_{c}"), F.lit(0)).alias(f"{c}_nulls") for c in required])

    def require(self, df: DataFrame) -> DataFrame:
        """df, if its schema and rows keep the contract; else an error that says what doesn't."""
        row = self.violations(self.check_schema(df)).first().asDict()
        bad = {k: v for k, v in row.items() if k != "n_rows" and v}
        if bad:
            raise ContractError(f"{self.name}: {bad}")
        return df

    def overlay(self, version: int, add: tuple[tuple[str, str, bool], ...] = (), remove: tuple[str, ...] = (), primary_key: tuple[str, ...] | None = None) -> TableContract:
        """The next version: columns taken away and added."""
        missing = set(remove) - {c for c, _, _ in self.columns}
        if missing:
            raise ContractError(f"can't remove {sorted(missing)}")
        return replace(self, version=version, columns=tuple(c for c in self.columns if c[0] not in remove) + tuple(add), primary_key=primary_key or self.primary_key)
