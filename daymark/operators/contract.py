"""Declared table schemas and what follows from them."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.functions.bounds import DateLike, day

VERSION_NAMES = ("row_eff_start_date", "row_eff_end_date", "current_row_flag")
CONTROL_NAMES = (
    "row_hash_value",
    "ctrl_create_user_id",
    "ctrl_create_ts",
    "ctrl_last_update_user_id",
    "ctrl_last_update_ts",
)


DDL_COLUMN = re.compile(r"(\w+)\s+(\w+(?:\([\d,\s]+\))?)\s*(?:,|$)")


class ContractError(ValueError):
    """A frame does not fit the declared schema of its table."""


def load_document(source: Mapping | str | Path) -> dict:
    """A dict as it is, or the content of a JSON or YAML file."""
    if isinstance(source, Mapping):
        return dict(source)
    path = Path(source)
    text = path.read_text(encoding="utf-8")
    if path.suffix in (".yaml", ".yml"):
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading YAML files needs the yaml package; JSON and dicts do not") from error
        return yaml.safe_load(text)
    return json.loads(text)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    data_type: str
    is_pkey: bool = False
    is_partition_col: bool = False
    domain: tuple[Any, ...] = ()

    @property
    def spark_type(self) -> T.DataType:
        return T.DataType.fromDDL(self.data_type)


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[ColumnSpec, ...]
    comment: str | None = None
    write_ordered_by: tuple[str, ...] = ()
    meta: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_ddl(
        cls, name: str, ddl: str, keys: Sequence[str] = (), partitions: Sequence[str] = (), **options
    ) -> TableContract:
        """From ``"name type, name type, ..."`` with simple types."""
        pairs = DDL_COLUMN.findall(ddl)
        return cls(name, tuple(ColumnSpec(n, t, n in keys, n in partitions) for n, t in pairs), **options)

    @classmethod
    def load(cls, source: Mapping | str | Path) -> TableContract:
        """From a schema document: name, columns with name/data_type/is_pkey/is_partition_col, comment, meta.

        A dimension (``dim_`` name) that declares validity columns also gets the control columns.
        """
        document = load_document(source)
        columns = [
            ColumnSpec(
                item["name"],
                item["data_type"],
                bool(item.get("is_pkey")),
                bool(item.get("is_partition_col")),
                tuple(item.get("domain", ())),
            )
            for item in document["columns"]
        ]
        return cls(
            document["name"],
            tuple(columns),
            document.get("comment"),
            tuple(document.get("write_ordered_by", ())),
            document.get("meta", {}),
        )

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.columns if c.is_pkey]

    @property
    def partitions(self) -> list[str]:
        return [c.name for c in self.columns if c.is_partition_col]

    @property
    def data_columns(self) -> list[str]:
        return [c for c in self.names if c not in {*self.partitions, *VERSION_NAMES, *CONTROL_NAMES}]

    @property
    def has_version_columns(self) -> bool:
        return set(VERSION_NAMES) <= set(self.names)

    @property
    def has_control_columns(self) -> bool:
        return set(CONTROL_NAMES) <= set(self.names)

    @property
    def is_dimension(self) -> bool:
        return self.name.startswith("dim_")

    @property
    def struct_type(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(
                    c.name, c.spark_type, True, {"is_pkey": c.is_pkey, "is_partition_col": c.is_partition_col}
                )
                for c in self.columns
            ]
        )


def contract_name(job_name: str) -> str:
    """Historical jobs share the schema of the table they refill."""
    return job_name.replace("_hist_", "_")


def contract_for(job_name: str, schemas: Mapping[str, Any], source_key: str | None = None) -> TableContract:
    """The contract of a job: the document filed under its name, or under a key that may embed it."""
    name = contract_name(job_name)
    key = (source_key or "{metadata_name}").replace("{metadata_name}", name)
    return TableContract.load(schemas[key])


def conform(
    df: DataFrame, contract: TableContract, strict: bool = False, cast: bool = True, pad: bool | Sequence[str] = False
) -> DataFrame:
    """Declared columns in declared order, cast to their declared types.

    Columns the frame lacks are left out, filled with typed NULLs with ``pad`` (all of them, or those it lists), or an error with ``strict``
    unless they are listed.
    """
    present = {name.lower(): name for name in df.columns}
    listed = set() if isinstance(pad, bool) else {name.lower() for name in pad}
    missing = [c.name for c in contract.columns if c.name.lower() not in present and c.name.lower() not in listed]
    if strict and missing:
        raise ContractError(f"{contract.name}: columns missing from the frame: {missing}")
    chosen = []
    for spec in contract.columns:
        if spec.name.lower() in present:
            column = F.col(f"`{present[spec.name.lower()]}`")
            chosen.append((column.cast(spec.data_type) if cast else column).alias(spec.name))
        elif pad is True or spec.name.lower() in listed:
            chosen.append(F.lit(None).cast(spec.data_type).alias(spec.name))
    return df.select(*chosen)


def partitions_last(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    return df.select(*[name for name in df.columns if name not in partitions], *partitions)


def rename_if_exists(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def fill_missing_with_date(df: DataFrame, contract: TableContract, run_date: DateLike) -> DataFrame:
    """Add every declared column the frame lacks, holding the run date."""
    present = {name.lower() for name in df.columns}
    missing = [name for name in contract.names if name.lower() not in present]
    return df.withColumns({name: day(run_date) for name in missing}) if missing else df


def apply_meta(df: DataFrame, contract: TableContract, run_date: DateLike) -> DataFrame:
    """Renames and fills a contract asks for in its ``meta`` section."""
    df = rename_if_exists(df, contract.meta.get("rename_columns_if_exists", {}))
    if contract.meta.get("fill_inexisting_columns_with_date"):
        df = fill_missing_with_date(df, contract, run_date)
    return df
