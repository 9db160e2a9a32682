"""The source reads of the offer marts, stated as data and loaded with one function.

A spec says which table a read takes, how its snapshot is chosen and how its text is cleaned. ``load``
turns it into a DataFrame; cleaning comes before the filters, so filters see cleaned text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.bounds import DateLike
from daymark.functions.cleaning import clean_strings
from daymark.functions.contacts import clean_landline_columns, clean_mobile_columns
from daymark.sources import snapshots

Reader = Callable[[str], DataFrame]

# Written by the loader itself, so there is nothing to clean; left as they are, filters on them prune partitions.
TECHNICAL = ("current_row_flag", "row_hash_value", "ctrl_create_user_id", "ctrl_last_update_user_id")

LIVE = "current_row_flag = 'Y' AND row_eff_end_date IS NOT NULL"


@dataclass(frozen=True)
class CatalogReader:
    """Reads catalog tables; where the snapshot column partitions a table, its latest date comes from the
    partition names instead of a scan. ``database`` is one name, or a name per table."""

    spark: SparkSession
    database: str | Mapping[str, str]

    def qualified(self, table: str) -> str:
        database = self.database if isinstance(self.database, str) else self.database[table]
        return f"{database}.{table}"

    def __call__(self, table: str) -> DataFrame:
        return self.spark.table(self.qualified(table))

    def latest_date(self, table: str, run_date: DateLike, column: str) -> dt.date:
        name = self.qualified(table)
        if column in [c.name for c in self.spark.catalog.listColumns(name) if c.isPartition]:
            return snapshots.latest_partition(self.spark, name, run_date, column)
        return snapshots.latest_date(self(table), run_date, column)


@dataclass(frozen=True)
class Source:
    """One read: ``mode`` is 'full', 'last', 'exact' or a number of trailing months."""

    table: str
    mode: str | int = "full"
    column: str = "actual_date"
    filters: tuple[str, ...] = ()
    skip_cleaning: tuple[str, ...] = ()
    mobile: tuple[str, ...] = ()
    landline: tuple[str, ...] = ()

    def select(self, reader: Reader, run_date: DateLike) -> DataFrame:
        df = reader(self.table)
        if isinstance(self.mode, int):
            return snapshots.month_period(df, run_date, self.mode, self.column)
        if self.mode == "last":
            if isinstance(reader, CatalogReader):
                return snapshots.exact(df, reader.latest_date(self.table, run_date, self.column), self.column)
            return snapshots.last(df, run_date, self.column)
        if self.mode == "exact":
            return snapshots.exact(df, run_date, self.column)
        if self.mode == "full":
            return df
        raise ValueError(f"unsupported read mode: {self.mode!r}")


def _live(table: str, *more: str, **options) -> Source:
    return Source(table, filters=(LIVE, *more), **options)


# Result name -> read.
SOURCES: dict[str, Source] = {
    # accounts, balances, products
    "df_customer_account": Source("df_customer_account", "last", "reporting_date"),
    "df_abt_customer": Source("df_abt_customer", "last", "business_date", skip_cleaning=("bbnumber",)),
    "df_adb": Source("df_adb", 4),
    "df_pm_eq": Source(
        "df_pm_eq", 1, "reporting_date", mobile=("eq_customer_mobile_phone", "borrower_mobile_number")
    ),
    "df_pm_eq_latest": Source(
        "df_pm_eq", "last", "reporting_date", mobile=("eq_customer_mobile_phone", "borrower_mobile_number")
    ),
    "pm_application": Source("pm_application", "last"),
    "staging_pm_al_non_grid_application_data": Source("staging_pm_al_non_grid_application_data"),
    "credit_card_processing_tu": Source("credit_card_processing_tu", 13, "business_date"),
    "df_cards_accounts": Source("df_cards_accounts", "exact", "reporting_date"),
    "scpf": Source("scpf", "last", "business_date"),
    "winnow_b_score_cc": Source("winnow_b_score_cc", "last", "period_date"),
    # customer lists
    "dosri_distinct": Source("dosri_distinct", "last"),
    "enfis_bbn": Source("enfis_bbn", "last"),
    "ref_risk_industry": Source("ref_risk_industry"),
    "pl_active_accounts": Source("pl_active_accounts", "last"),
    "pl_active_accounts_woff": Source("pl_active_accounts_woff", "last"),
    "salad_accounts": Source("salad_accounts", "last"),
    # scores and segments
    "ptbcasatocc": Source("ptbcasatocc", "last", "business_date"),
    "ptbcasatoal": Source("ptbcasatoal", "last", "business_date"),
    "casatohlptb": Source("casatohlptb", "last", "business_date"),
    "depo_segmentation_v2": Source("depo_segmentation_v2", "last", "business_date"),
    "depo_clusters_v2": Source("depo_clusters_v2", "last", "business_date"),
    "incomeestimatorv2": Source("incomeestimatorv2", "last", "business_date"),
    # customer dimensions
    "dim_cust_indiv": _live("dim_cust_indiv"),
    "dim_cust_indiv_pii": _live("dim_cust_indiv_pii"),
    "dim_cust_indiv_employment": _live("dim_cust_indiv_employment"),
    "dim_cust_class": _live("dim_cust_class"),
    "dim_cust_contact": _live("dim_cust_contact"),
    "dim_cust_contact_email": _live("dim_cust_contact", "contact_category_desc LIKE 'Email%'"),
    "dim_cust_contact_mobile": _live("dim_cust_contact", "contact_category_desc LIKE 'Mobile Number%'"),
    "dim_cust_contact_landline": _live("dim_cust_contact", "contact_category_desc LIKE 'Landline%'"),
    "dim_cust_contact_pii": _live("dim_cust_contact_pii"),
    "dim_cust_contact_pii_email": _live("dim_cust_contact_pii"),
    "dim_cust_contact_pii_mobile": _live("dim_cust_contact_pii", mobile=("contact_details_text",)),
    "dim_cust_contact_pii_landline": _live("dim_cust_contact_pii", landline=("contact_details_text",)),
    "dim_cust_address": _live("dim_cust_address"),
    "dim_cust_address_pii": _live("dim_cust_address_pii"),
    "dim_cust_id_proof": _live("dim_cust_id_proof"),
    "dim_cust_id_proof_pii": _live("dim_cust_id_proof_pii"),
    "cust_info": Source("cust_info", "exact"),
    "branch_listing": Source("branch_listing", "last"),
    "business_days": Source("business_days"),
    "holidays": Source("holidays"),
    # campaign activity
    "activity": Source("activity", "last"),
    "lookupmaster": Source("lookupmaster", "last"),
    "act_ex1": Source("act_ex1", "last"),
    "acc_ex1": Source("acc_ex1", "last"),
    "acc_ex2": Source("acc_ex2", "last"),
    "lea_ex1": Source("lea_ex1", "last"),
    "leads": Source("leads", "last"),
    "products": Source("products", "last"),
    # own tables
    "staging_cross_sell_base": Source("staging_cross_sell_base", "exact"),
    "dm_cross_sell_base": Source("dm_cross_sell_base", "exact"),
}

# Own offer tables are read back over two trailing months.
for _product in ("al", "cc", "hl"):
    for _kind in ("stp", "ptb"):
        _table = f"dm_casa_to_{_product}_cross_sell_{_kind}_offers"
        SOURCES[f"{_table}_for_month"] = Source(_table, 2)


def load(source: Source, reader: Reader, run_date: DateLike) -> DataFrame:
    df = clean_strings(source.select(reader, run_date), skip=(*source.skip_cleaning, *TECHNICAL))
    if source.mobile:
        df = clean_mobile_columns(df, source.mobile)
    if source.landline:
        df = clean_landline_columns(df, source.landline)
    return snapshots.where_all(df, *source.filters)


def load_together(specs: Mapping[str, Source], reader: Reader, run_date: DateLike, tag: str = "reads") -> DataFrame:
    """Several reads of one table in one scan: the rows that any of them takes, with the names of those that do in the array ``tag``.

    The reads may differ in their filters only. Filters that all share are applied to the scan, so they still prune; the others become
    tags. Rows of one read are ``where(array_contains(tag, name))``.
    """
    if not specs:
        raise ValueError("no reads given")
    names, reads = list(specs), list(specs.values())
    if len({replace(s, filters=()) for s in reads}) > 1:
        raise ValueError(f"these reads differ in more than their filters: {', '.join(names)}")
    shared = tuple(f for f in reads[0].filters if all(f in s.filters for s in reads))
    df = load(replace(reads[0], filters=shared), reader, run_date)
    taken = []
    for name, source in specs.items():
        own = [F.expr(f"({f})") for f in source.filters if f not in shared]
        taken.append(F.when(reduce(and_, own), F.lit(name)) if own else F.lit(name))
    return df.withColumn(tag, F.array_compact(F.array(*taken))).where(F.size(tag) > 0)


def fusible(specs: Mapping[str, Source]) -> list[list[str]]:
    """Names of reads that ``load_together`` can take in one scan, in their order; groups of one are left out."""
    groups: dict[Source, list[str]] = {}
    for name, source in specs.items():
        groups.setdefault(replace(source, filters=()), []).append(name)
    return [names for names in groups.values() if len(names) > 1]


@dataclass
class Sources:
    """Loads the named reads on demand and keeps the DataFrames for the run."""

    reader: Reader
    run_date: DateLike
    specs: dict[str, Source] = field(default_factory=lambda: SOURCES)
    _loaded: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._loaded:
            self._loaded[name] = load(self.specs[name], self.reader, self.run_date)
        return self._loaded[name]

    def register(self, names: Iterable[str]) -> None:
        """Publish reads as temp views for SQL steps."""
        for name in names:
            self[name].createOrReplaceTempView(name)
