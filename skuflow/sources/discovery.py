"""Finding the newest dated report per source.

File names carry the report date: ``<prefix>YYYY-MM-DD<ext>``. A listing is a
DataFrame with a ``name`` column (from a directory listing, or derived data).
Selection is an aggregate (``max_by`` over a score), never a sort of the listing
and never a per-prefix window, so a prefix with very many files is still
reduced map-side.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, directory: str, glob: str = "*", folders: bool = False) -> DataFrame:
    """Listing of one directory as (path, name), empty files included; contents are never read.
    ``folders`` lists matching folders too: exports are folders of numbered files."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(directory)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder, glob)) or [] if folders or s.isFile()]
    return spark.createDataFrame([(p.toString(), p.getName()) for p in found], "path string, name string")


def _parsed(listing: DataFrame, prefixes: Sequence[str], extensions: Sequence[str], name: str) -> DataFrame:
    """prefix (as configured), report_date, ext, ext_rank; NULLs where no match.
    Each regex group is extracted once; prefix and extension rank are map
    lookups rather than CASE chains (which would re-run the extraction per branch)."""
    alt_p = "|".join(re.escape(p) for p in prefixes)
    alt_e = "|".join(re.escape(e) for e in extensions)
    pattern = f"(?i)^({alt_p})(\\d{{4}}-\\d{{2}}-\\d{{2}})({alt_e})$"
    n = F.col(name)
    prefix_of = F.create_map(*[x for p in prefixes for x in (F.lit(p.lower()), F.lit(p))])
    rank_of = F.create_map(*[x for i, e in enumerate(extensions) for x in (F.lit(e.lower()), F.lit(i))])
    raw = listing.withColumns({"_p": F.lower(F.regexp_extract(n, pattern, 1)),
                               "_d": F.regexp_extract(n, pattern, 2),
                               "ext": F.lower(F.regexp_extract(n, pattern, 3))})
    return (raw.withColumns({"prefix": F.element_at(prefix_of, F.col("_p")),
                             "report_date": F.try_to_date(F.nullif(F.col("_d"), F.lit("")), "yyyy-MM-dd"),
                             "ext_rank": F.element_at(rank_of, F.col("ext"))})
            .drop("_p", "_d"))


def parse_names(listing: DataFrame, prefixes: Sequence[str], extensions: Sequence[str] = (".csv",),
                name: str = "name") -> DataFrame:
    """add prefix (as configured), report_date (NULL when impossible), ext and
    ext_rank. Prefix and extension match case-insensitively (L18); names that
    match no prefix, or carry an impossible date, are dropped."""
    return (_parsed(listing, prefixes, extensions, name)
            .where(F.col("prefix").isNotNull() & F.col("report_date").isNotNull()))


def latest_per_prefix(listing: DataFrame, prefixes: Sequence[str], extensions: Sequence[str] = (".csv",),
                      run_date=None, name: str = "name") -> DataFrame:
    """Per prefix, the file dated ``run_date`` if there is one (L17), else
    the newest date; ties broken by extension-list order, then by name.

    Unmatched names are not filtered before the aggregate (a pushed-down filter
    would repeat the parsing inside the scan); a dated name always outranks an
    undated one, and the few non-matching groups are dropped afterwards."""
    parsed = _parsed(listing, prefixes, extensions, name)
    run = F.to_date(F.lit(str(run_date))) if run_date is not None else F.current_date()
    score = F.struct((F.col("report_date") == run).alias("today"), F.col("report_date"),
                     (-F.col("ext_rank")).alias("ext"), F.col(name).alias("n"))
    pick = F.max_by(F.struct(F.col(name).alias("name"), "report_date"), score)
    return (parsed.groupBy("prefix").agg(pick.alias("_p"))
            .select("prefix", "_p.name", "_p.report_date")
            .where(F.col("prefix").isNotNull() & F.col("report_date").isNotNull()))


def find_latest(spark: SparkSession, directory: str, prefix: str, extensions: Sequence[str] = (".csv",),
                run_date=None) -> tuple[str, str] | None:
    """Driver-side convenience for pipelines: (path, report_date ISO) or None.
    Collects at most one row (file selection is metadata, not data)."""
    listing = list_files(spark, directory)
    hit = latest_per_prefix(listing, [prefix], extensions, run_date)
    joined = hit.join(listing, "name").select("path", "report_date").limit(1).collect()
    if not joined:
        return None
    return joined[0]["path"], joined[0]["report_date"].isoformat()


def find_latest_many(spark: SparkSession, directory: str, wanted: dict, run_date=None) -> dict:
    """The newest file for many prefixes with one listing and one job.

    ``wanted``: prefix -> extensions tuple. Returns prefix -> (path, ISO date)
    for the prefixes that have a file (one small row per prefix reaches the
    driver: file selection is metadata, not data)."""
    listing = list_files(spark, directory)
    by_ext: dict = {}
    for prefix, exts in wanted.items():
        by_ext.setdefault(tuple(exts), []).append(prefix)
    picks = [latest_per_prefix(listing, prefixes, exts, run_date) for exts, prefixes in by_ext.items()]
    hits = picks[0]
    for p in picks[1:]:
        hits = hits.unionByName(p)
    rows = hits.join(listing, "name").select("prefix", "path", "report_date").collect()
    return {r.prefix: (r.path, r.report_date.isoformat()) for r in rows}
