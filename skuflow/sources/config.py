"""Configuration dimensions (S9): SKU catalog, channel lists and mapping tables.

The reference keeps these in five JSON files. Here they become small DataFrames:
lists carry an explicit rank (rows have no order), maps become
(source_key, targets) tables. A catalog built from Python values has a known
size and may be broadcast; a mapping read from a (possibly large) JSON file is
left to the planner and AQE, which measure it before choosing a broadcast.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONFIG_FILES = {
    "tpl": "flexport_map.json",
    "tiktok": "tiktok_map.json",
    "shopify": "shopify_map.json",
    "amazon": "amazon_map.json",
    "catalog": "catalog.json",
}


#: Key of the mapping document in each mapping file.
MAPPING_KEYS = {"amazon": "AMAZON_SKU_MAP", "tiktok": "TIKTOK_ID_MAP", "shopify": "SHOPIFY_SKU_MAP"}


class ConfigError(ValueError):
    pass


class DuplicateKeys(ValueError):
    """A mapping gives one source key two target lists."""


@dataclass(frozen=True)
class Catalog:
    sku_order: tuple = ()
    channel_order: tuple = ()
    sales_channel_order: tuple = ()
    amazon_skus: tuple = ()
    amazon_map: dict = field(default_factory=dict)
    tiktok_map: dict = field(default_factory=dict)
    shopify_map: dict = field(default_factory=dict)
    dsku_map: dict = field(default_factory=dict)
    mapping_paths: dict = field(default_factory=dict)   # which -> (path, key): mappings that Spark reads itself

    @staticmethod
    def from_dir(path: str) -> "Catalog":
        """Missing or invalid configuration is a hard error. Lists and maps of configuration size."""
        docs = {}
        for key, name in CONFIG_FILES.items():
            full = os.path.join(path, name)
            try:
                with open(full, encoding="utf-8") as fh:
                    docs[key] = json.load(fh)
            except FileNotFoundError as e:
                raise ConfigError(f"configuration file missing: {full}") from e
            except json.JSONDecodeError as e:
                raise ConfigError(f"invalid JSON in configuration file {full}: {e}") from e
        cat = docs["catalog"]
        return Catalog(
            sku_order=tuple(str(s) for s in cat.get("SKU_ORDER", [])),
            channel_order=tuple(cat.get("CHANNEL_ORDER", [])),
            sales_channel_order=tuple(cat.get("SALES_CHANNEL_ORDER", [])),
            amazon_skus=tuple(str(s) for s in cat.get("AMAZON_SKUs", [])),
            amazon_map=docs["amazon"].get("AMAZON_SKU_MAP", {}),
            tiktok_map=docs["tiktok"].get("TIKTOK_ID_MAP", {}),
            shopify_map=docs["shopify"].get("SHOPIFY_SKU_MAP", {}),
            dsku_map=docs["tpl"].get("DSKU_TO_SKU_MAP", {}),
        )

    @staticmethod
    def from_spark(path: str) -> "Catalog":
        """As ``from_dir``, but the marketplace mappings stay in their files and are read by Spark when a
        run joins them, so a mapping of any size never passes the driver. A missing file is a hard error."""
        full = {k: os.path.join(path, CONFIG_FILES[k]) for k in MAPPING_KEYS}
        for f in full.values():
            if not os.path.exists(f):
                raise ConfigError(f"configuration file missing: {f}")
        docs = {}
        for key in ("catalog", "tpl"):
            try:
                with open(os.path.join(path, CONFIG_FILES[key]), encoding="utf-8") as fh:
                    docs[key] = json.load(fh)
            except (FileNotFoundError, json.JSONDecodeError) as e:
                raise ConfigError(f"configuration file missing or invalid: {CONFIG_FILES[key]}") from e
        cat = docs["catalog"]
        return Catalog(tuple(str(s) for s in cat.get("SKU_ORDER", [])), tuple(cat.get("CHANNEL_ORDER", [])),
                       tuple(cat.get("SALES_CHANNEL_ORDER", [])), tuple(str(s) for s in cat.get("AMAZON_SKUs", [])),
                       dsku_map=docs["tpl"].get("DSKU_TO_SKU_MAP", {}),
                       mapping_paths={k: (full[k], MAPPING_KEYS[k]) for k in MAPPING_KEYS})

    # Dimensions built from configuration values; Spark chooses the join by their size.
    def sku_dim(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(s, i) for i, s in enumerate(self.sku_order)], "SKU string, sku_rank int")

    def allowed_dim(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(s,) for s in self.amazon_skus], "SKU string")

    def mapping_dim(self, spark: SparkSession, which: str) -> DataFrame:
        if which in self.mapping_paths:
            return unique_mapping(read_mapping(spark, *self.mapping_paths[which]))
        m = {"amazon": self.amazon_map, "tiktok": self.tiktok_map, "shopify": self.shopify_map}[which]
        rows = [(str(k), [str(t) for t in (v or [])]) for k, v in m.items()]
        return spark.createDataFrame(rows, "source_key string, targets array<string>")

    def dsku_dim(self, spark: SparkSession) -> DataFrame:
        rows = [(str(k), str(v)) for k, v in self.dsku_map.items()]
        return spark.createDataFrame(rows, "dsku string, SKU string")


def read_mapping(spark: SparkSession, path: str, key: str) -> DataFrame:
    """S9 at scale: mapping files read and exploded by Spark into (source_key, targets).

    A ``{key: {source: [targets]}}`` document is one record; a large mapping is a folder of such
    documents, or JSON Lines of them, which Spark reads in parallel. NULL target lists become
    empty, NULL targets go.
    """
    whole = spark.read.schema(f"`{key}` map<string,array<string>>")
    doc = whole.json(path) if _is_lines(spark, path) else whole.option("multiLine", True).json(path)
    rows = doc.where(F.col(key).isNotNull()).select(F.explode(key).alias("source_key", "targets"))
    none = F.array().cast("array<string>")
    return rows.select("source_key", F.coalesce(F.filter("targets", lambda t: t.isNotNull()), none).alias("targets"))


def _is_lines(spark: SparkSession, path: str) -> bool:
    """JSON Lines: some file's first line is a whole document."""
    first = spark.read.text(path).limit(1).collect()
    try:
        return bool(first) and isinstance(json.loads(first[0].value), dict)
    except json.JSONDecodeError:
        return False


def unique_mapping(mapping: DataFrame) -> DataFrame:
    """One row per source key. Keys that repeat one and the same list are folded; two lists for one
    key raise DuplicateKeys before any join could count its volume twice (one aggregate over the keys)."""
    folded = mapping.groupBy("source_key").agg(F.min("targets").alias("targets"), F.max("targets").alias("_other"))
    twice = folded.where(~F.col("targets").eqNullSafe(F.col("_other")))
    bad = [r.source_key for r in twice.select("source_key").limit(5).collect()]
    if bad:
        raise DuplicateKeys(f"mapping keys with more than one target list, such as {bad}")
    return folded.drop("_other")


def read_ordered_list(spark: SparkSession, path: str, key: str, name: str = "SKU") -> DataFrame:
    """Ordered list -> (name, rank) via ``posexplode`` (Spark rows carry no order)."""
    doc = spark.read.option("multiLine", True).schema(f"`{key}` array<string>").json(path)
    return doc.select(F.posexplode(key).alias(f"{name.lower()}_rank", name))
