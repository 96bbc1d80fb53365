"""Star-schema build: four dimensions with dense surrogate keys and the fact.

PREPARED is materialised once (written as Parquet to the shared checkpoint
folder) because five builds read it.  Each dimension is a distinct /
max-per-key aggregate numbered by ``assign_dense_keys`` (no single-task
window).  The fact attaches the four keys with left joins on the natural
keys; a dimension is broadcast only when its exact row count (known from key
assignment) passes the size check, otherwise the join shuffles and AQE may
split skewed keys.  Under the frame rules keys match NULL to NULL.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import calendar as cal
from starmart.operators.joins import broadcast_or_merge, can_broadcast, lookup_known_keys
from starmart.operators.keys import Keyed, assign_dense_keys, build_dimension, measured
from starmart.schemas import (
    FACT_EXTRA_SQL,
    FACT_MEASURES,
    LOCATION_KEY,
    LOCATION_SK,
    OFFENCE_KEY,
    OFFENCE_SK,
    OFFENDER_KEY,
    OFFENDER_SK,
    TIME_KEY,
    TIME_SK,
)
from starmart.plans.prepare import POSITION
from starmart.session import drop_work, work_dir, write_settings

DIMENSIONS = {
    "dim_tempo": TIME_SK,
    "dim_localizacao": LOCATION_SK,
    "dim_infracao": OFFENCE_SK,
    "dim_infrator": OFFENDER_SK,
}
FACT_YEAR = "ano_fato"  # partition column of the written fact; reports take the year itself from the time dimension
LOCATION_ORDER = ["uf_infracao", "municipio", "br_infracao", "km_infracao", "regiao_infracao", "sentido_trafego"]
LOCATION_COLUMNS = ["uf_infracao", "br_infracao", "km_infracao", "municipio", "regiao_infracao", "sentido_trafego"]


@dataclass
class Star:
    """The five star tables plus the exact row count of each dimension."""

    dim_tempo: DataFrame
    dim_localizacao: DataFrame
    dim_infracao: DataFrame
    dim_infrator: DataFrame
    fato_multa: DataFrame
    rows: dict[str, int] = field(default_factory=dict)
    rules: str = "sql"
    prepared: DataFrame | None = None
    sizes: dict[str, int] = field(default_factory=dict)  # measured bytes per dimension
    fato_ano: DataFrame | None = None  # the fact with its partition column, the year
    folders: list[str] = field(default_factory=list)  # written by the build, in the shared work folder

    def facts(self) -> DataFrame:
        """The fact for reports: with the year it is partitioned by, where it has one."""
        return self.fato_ano if self.fato_ano is not None else self.fato_multa

    def in_year(self, year: int):
        """Predicate that reads one year's partition of ``facts()`` (always true where the fact has no year)."""
        return F.col(FACT_YEAR) == year if FACT_YEAR in self.facts().columns else F.lit(True)

    def drop(self) -> None:
        """Remove the folders the build wrote; the tables of this star cannot be read afterwards."""
        drop_work(self.dim_tempo.sparkSession, *self.folders)
        self.folders.clear()

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def small(self, name: str) -> bool:
        return can_broadcast(self.table(name), self.rows.get(name), self.sizes.get(name))

    def dim(self, name: str, *cols: str) -> DataFrame:
        """Projection of a dimension (key first), broadcast when its checked size allows, else joined by sort and merge."""
        sk = DIMENSIONS[name]
        d = self.table(name).select(sk, *[c for c in cols if c != sk])
        return broadcast_or_merge(d, self.rows.get(name), self.sizes.get(name))


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, folders: list[str] | None = None,
                sort_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back (lineage cut, survives executor loss).

    A partitioned write keeps the tasks of its input, each writing one file per value it holds: the rows do not cross
    the network again for the few values (years) there are.  ``folders`` collects the path.
    """
    path = work_dir(df.sparkSession, name)
    if folders is not None:
        folders.append(path)
    out = df.sortWithinPartitions(*(partition_by or []), *sort_by) if sort_by else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with write_settings(df.sparkSession):
        w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)  # an empty partitioned write has no file to infer from


def build_dim_time(prepared: DataFrame, first: int = 1, holidays: str = "listed", first_seen: str | None = None):
    dated = prepared.filter(F.col("data_infracao").isNotNull())
    if first_seen:
        base = dated.groupBy(*TIME_KEY).agg(F.min(first_seen).alias("__first"))
        keyed = assign_dense_keys(base, ["__first"], TIME_SK, first=first)
    else:
        keyed = assign_dense_keys(dated.select(*TIME_KEY).distinct(), TIME_KEY, TIME_SK, first=first)
    parts = cal.date_parts("data_infracao")
    df = keyed.df.select(
        TIME_SK,
        "data_infracao",
        *[v.alias(k) for k, v in parts.items()],
        cal.is_holiday("data_infracao", holidays).alias("is_feriado"),
    )
    # the calendar parts are added after numbering: about 48 more bytes per row
    return Keyed(df, keyed.rows, (keyed.bytes or 0) + 48 * keyed.rows, keyed.path)


def build_star(
    prepared: DataFrame,
    rules: str = "sql",
    holidays: str = "listed",
    materialize_tables: bool = True,
    timings: dict[str, float] | None = None,
) -> Star:
    """Build the star from PREPARED; ``timings`` (optional) receives wall seconds per phase."""
    clock = [time.time()]

    def lap(phase: str) -> None:
        now = time.time()
        if timings is not None:
            timings[phase] = round(now - clock[0], 3)
        clock[0] = now

    first = 1 if rules == "sql" else 0
    null_safe = rules == "frame"
    # frame rules number keys by first occurrence when rows carry their file position
    seen = POSITION if (rules == "frame" and POSITION in prepared.columns) else None
    folders: list[str] = []
    if materialize_tables:
        # written once: five builds read it, and one-year work reads its year only
        prepared = materialize(prepared, f"prepared_{rules}", ["ano"], folders)
    lap("prepared")

    def loc_dim():
        k = build_dimension(prepared, LOCATION_KEY, LOCATION_SK, order=LOCATION_ORDER, first=first, first_seen=seen)
        return Keyed(k.df.select(LOCATION_SK, *LOCATION_COLUMNS), k.rows, k.bytes, k.path)

    def offence_dim():
        attrs = {"descricao_infracao": "descricao_abreviada_infracao", "enquadramento_infracao": "enquadramento_infracao"}
        return build_dimension(prepared, OFFENCE_KEY, OFFENCE_SK, first=first, attrs_max=attrs)

    def offender_dim():
        return build_dimension(prepared, OFFENDER_KEY, OFFENDER_SK, first=first, first_seen=seen)

    builders = {
        "dim_tempo": lambda: build_dim_time(prepared, first, holidays, seen),
        "dim_localizacao": loc_dim,
        "dim_infracao": offence_dim,
        "dim_infrator": offender_dim,
    }
    # the four dimensions are independent job chains: submit them together.  Each is written once, by the key
    # assignment; its table is that file joined to the small offsets of the file's partitions.
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        futures = {name: pool.submit(fn) for name, fn in builders.items()}
        built = {name: fut.result() for name, fut in futures.items()}
    folders += [k.path for k in built.values()]
    rows = {name: k.rows for name, k in built.items()}
    sizes = {name: k.bytes for name, k in built.items()}
    dims = {name: k.df for name, k in built.items()}
    lap("dimensions")

    keys_of = {"dim_tempo": TIME_KEY, "dim_localizacao": LOCATION_KEY, "dim_infracao": OFFENCE_KEY, "dim_infrator": OFFENDER_KEY}
    lookups = [(dims[n], keys_of[n], DIMENSIONS[n], rows[n], sizes[n]) for n in DIMENSIONS]
    f = lookup_known_keys(prepared, lookups, null_safe)
    extra = FACT_EXTRA_SQL if rules == "sql" else []
    published = [TIME_SK, LOCATION_SK, OFFENCE_SK, OFFENDER_SK, *FACT_MEASURES, *extra]
    fact = f.select(*published, F.col("ano").alias(FACT_YEAR))
    if materialize_tables:
        # one folder per year, clustered by the time key inside each file: a year is read by itself, and row-group
        # statistics let runtime filters from a selective time predicate skip more
        fact = materialize(fact, f"fato_multa_{rules}", [FACT_YEAR], folders, sort_by=[TIME_SK])
    lap("fact")

    return Star(
        **dims, fato_multa=fact.select(*published), fato_ano=fact, rows=rows, rules=rules, prepared=prepared, sizes=sizes, folders=folders,
    )


def register_views(star: Star, prefix: str = "") -> list[str]:
    """Expose the star (and PREPARED) as temporary views for SQL users."""
    names = []
    for name in ("dim_tempo", "dim_localizacao", "dim_infracao", "dim_infrator", "fato_multa"):
        star.table(name).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    if star.prepared is not None:
        star.prepared.createOrReplaceTempView(prefix + "prepared")
        names.append(prefix + "prepared")
    return names


TABLES = ("dim_tempo", "dim_localizacao", "dim_infracao", "dim_infrator", "fato_multa")


def write_star(star: Star, target_dir: str) -> dict[str, str]:
    """Replace the five star tables under ``target_dir`` (one Parquet folder each); returns their paths."""
    from starmart.sources.sinks import write_table

    paths = {}
    for name in TABLES:
        path = f"{target_dir.rstrip('/')}/{name}"
        write_table(star.table(name), path=path, mode="overwrite")
        paths[name] = path
    return paths


def star_from_tables(spark: SparkSession, paths: dict[str, str], rules: str = "sql") -> Star:
    """Open a star written by ``write_star``; rows and bytes of each dimension are measured again."""
    tables = {k: spark.read.parquet(p) for k, p in paths.items() if k in TABLES}
    found = {k: measured(tables[k]) for k in DIMENSIONS}
    return Star(rules=rules, rows={k: n for k, (n, _) in found.items()}, sizes={k: b for k, (_, b) in found.items()}, **tables)


def write_bucketed_star(star: Star, target_dir: str, key: str = OFFENDER_SK, buckets: int = 64, prefix: str = "") -> Star:
    """The star with its fact and the dimension of ``key`` written as catalog tables bucketed by it.

    Joins of the two on ``key`` read matching buckets side by side: neither is shuffled, however large the dimension.
    Choose the largest dimension's key and about (fact bytes / 200 MB) buckets.  The other dimensions stay as they are.
    """
    from starmart.sources.sinks import write_bucketed

    spark, base = star.dim_tempo.sparkSession, target_dir.rstrip("/")
    name = next(n for n, sk in DIMENSIONS.items() if sk == key)
    tables = {n: star.table(n) for n in TABLES}
    for n in (name, "fato_multa"):
        write_bucketed(star.table(n), prefix + n, f"{base}/{n}", key, buckets)
        tables[n] = spark.table(prefix + n)
    return Star(**tables, rows=star.rows, sizes=star.sizes, rules=star.rules, prepared=star.prepared)
