"""Versioned, hash-bucketed Parquet tables with an atomic publish (M1, M4, M5, M7, V9).

Layout under ``root`` (a shared folder -- on a cluster the one named by
``spark.checkpoint.dir`` or any distributed path)::

    <table>/layer=<version>-<attempt>/terrace_bucket=<b>/part-*.parquet   immutable files
    _versions/version=<n>/manifest.json                                   one line per publish

Rows are spread over hash buckets of the primary key (``pmod(xxhash64(key), buckets)``, written
with ``partitionBy``); how many is decided at a table's first write and kept in the manifest.
A table in the manifest is its schema plus, for every bucket, the layer that holds it.
Reading a table is one scan whose partition filter names those (layer, bucket) pairs.  An upsert
writes a layer of the buckets its batch touches -- the cost follows the batch, not the table.
``compact`` writes a table anew as one layer; it is a call of its own and never part of a load.

A batch stages every new file set first, runs the integrity checks against the
staged state, and only then claims the next version: its manifest file is put in place by an
operation that fails if the name is taken (a hard link on a local path, ``rename`` without overwriting
elsewhere), so of two writers that start from one version exactly one gets it.  The other looks at what came in between.
Where that touches none of its own buckets, it puts its layers on top, checks the new state
and claims the version after; otherwise an upsert is staged again from the new state, and a
whole-table publish fails with ``ConflictError``.  Readers resolve the newest manifest and never see
a half-loaded batch; files of attempts that failed are never read and never in the way.

``create_live_views`` registers the tables as SQL views that find the newest manifest whenever a query is
analysed and run: a view made once shows what is published later.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid
from functools import reduce
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators.integrity import duplicate_keys, integrity_report
from terrace.operators.upsert import check_batch_keys, upsert
from terrace.schemas import LEAGUE_TABLES, LOAD_ORDER, with_defaults

BUCKET = "terrace_bucket"
LAYER = "layer"
#: Manifests that are kept; older ones go when a version is published.
HISTORY = 64
#: How often a load is staged again after a conflict.
RETRIES = 8
_LIVE = "struct<version:bigint,tables:map<string,struct<owners:array<string>>>>"


class IntegrityError(RuntimeError):
    pass


class ConflictError(RuntimeError):
    """Another writer published a version that this one's changes cannot be put on top of."""


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, specs=None, buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = specs or LEAGUE_TABLES
        self.buckets = int(buckets)  # of tables written for the first time

    # -- manifest --------------------------------------------------------
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _versions(self) -> list[int]:
        """Published versions that are still kept, ascending: a listing of names, at most HISTORY or so."""
        fs, p = self._fs(f"{self.root}/_versions")
        if not fs.exists(p):
            return []
        found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(p, "version=*/manifest.json")) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def current(self) -> dict:
        versions = self._versions()
        if not versions:
            return {"version": 0, "tables": {}}
        fs, p = self._fs(f"{self.root}/_versions/version={versions[-1]}/manifest.json")
        stream = fs.open(p)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            m = json.loads(text)
            return {"version": int(m["version"]), "tables": m["tables"]}
        except (ValueError, KeyError, TypeError) as e:
            raise RuntimeError(f"malformed manifest {p}: {e}") from e

    def _claim(self, version: int, tables: dict) -> bool:
        """Put the manifest of ``version`` in place; False if another writer has it already."""
        text = json.dumps({"version": version, "published_at": _dt.datetime.now(_dt.timezone.utc).isoformat(), "tables": tables})
        fs, staged = self._fs(f"{self.root}/_staged/{uuid.uuid4().hex}.json")
        out = fs.create(staged, False)
        try:
            out.write(text.encode())
        finally:
            out.close()
        _, final = self._fs(f"{self.root}/_versions/version={version}/manifest.json")
        fs.mkdirs(final.getParent())
        try:
            if fs.getUri().getScheme() == "file":
                os.link(urlparse(staged.toString()).path, urlparse(final.toString()).path)
            else:
                hadoop = self.spark._jvm.org.apache.hadoop.fs
                rename = getattr(hadoop, "Options$Rename")
                none = self.spark.sparkContext._gateway.new_array(rename, 1)
                none[0] = rename.NONE
                hadoop.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(staged, final, none)
        except FileExistsError:
            return False
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            fs.delete(staged, False)
        for old in [v for v in self._versions() if v <= version - HISTORY]:
            fs.delete(self._fs(f"{self.root}/_versions/version={old}")[1], True)
        return True

    @staticmethod
    def _on_top(base: dict, now: dict, changes: dict) -> dict | None:
        """The tables of ``now`` with ``changes`` (staged from ``base``) applied; None where they conflict: a table
        replaced or dropped by either side, or a bucket that both rewrote."""
        out = dict(now["tables"])
        for name, (entry, touched) in changes.items():
            was, here = base["tables"].get(name), now["tables"].get(name)
            if was != here:
                if touched is None or was is None or here is None or entry is None:
                    return None
                if (was["schema"], was["buckets"]) != (here["schema"], here["buckets"]):
                    return None
                if any(was["owners"][b] != here["owners"][b] for b in touched):
                    return None
            if entry is None:
                out.pop(name, None)
            elif touched is None:
                out[name] = entry
            else:
                owners = list(out[name]["owners"])
                for b in touched:
                    owners[b] = entry["owners"][b]
                out[name] = dict(entry, owners=owners)
        return out

    def _commit(self, base: dict, changes: dict, check=None) -> dict | None:
        """Check and publish ``changes`` -- table -> (entry or None, touched buckets or None for all) -- staged from
        ``base``; None if another writer's version conflicts with them."""
        now = base
        while True:
            staged = self._on_top(base, now, changes)
            if staged is None:
                return None
            if check:
                check(staged)
            if self._claim(now["version"] + 1, staged):
                return {"version": now["version"] + 1, "tables": sorted(staged)}
            now = self.current()

    def _load(self, stage, check=None, retries: int = RETRIES) -> dict:
        """``stage(base, folder)`` gives the changes; staged again after a conflict, up to ``retries`` times."""
        for _ in range(retries + 1):
            base = self.current()
            folder = f"v{base['version'] + 1}-{uuid.uuid4().hex[:12]}"
            done = self._commit(base, stage(base, folder), check)
            if done:
                return done
        raise ConflictError("another writer changed what this load replaces")

    # -- reading ---------------------------------------------------------
    def _path(self, table: str, folder: str) -> str:
        return f"{self.root}/{table}/{LAYER}={folder}"

    def _read_entry(self, table: str, entry: dict) -> DataFrame:
        """One scan: the partition filter keeps the buckets that each layer still holds."""
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        full = T.StructType(schema.fields + [T.StructField(LAYER, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        held: dict[str, list[int]] = {}
        for b, folder in enumerate(entry["owners"]):
            held.setdefault(folder, []).append(b)
        live = reduce(lambda x, y: x | y, [(F.col(LAYER) == f) & F.col(BUCKET).isin(bs) for f, bs in held.items()])
        df = self.spark.read.schema(full).option("basePath", f"{self.root}/{table}").parquet(*[self._path(table, f) for f in held])
        return df.where(live).select(*schema.names)

    def read(self, table: str) -> DataFrame:
        """The table as of the newest published version (resolved per call, V9)."""
        e = self.current()["tables"].get(table)
        if e is None:
            raise KeyError(f"table {table!r} has no published version")
        return self._read_entry(table, e)

    def exists(self, table: str) -> bool:
        return table in self.current()["tables"]

    def tables(self) -> dict[str, DataFrame]:
        cur = self.current()
        return {t: self._read_entry(t, e) for t, e in cur["tables"].items()}

    def live_sql(self, table: str) -> str:
        """SQL of ``table`` at its newest version.  The files and the manifest are looked up when a query is analysed,
        the newest manifest is picked inside the plan, and its (layer, bucket) pairs -- one row a bucket, broadcast --
        prune the partitions of a native Parquet scan."""
        names = ", ".join(f"f.`{c}`" for c in T.StructType.fromJson(json.loads(self.current()["tables"][table]["schema"])).names)
        return f"""
            SELECT /*+ BROADCAST(live) */ {names} FROM parquet.`{self.root}/{table}` AS f JOIN (
              SELECT owner, pos FROM (
                SELECT from_json(value, '{_LIVE}') AS m FROM text.`{self.root}/_versions`
                WHERE version = (SELECT max(version) FROM text.`{self.root}/_versions`))
              LATERAL VIEW posexplode(m.tables['{table}'].owners) AS pos, owner) AS live
            ON f.{LAYER} = live.owner AND f.{BUCKET} = live.pos"""

    def create_live_views(self, prefix: str = "") -> list[str]:
        """V9: temp views ``<prefix><table>`` of all published tables.  They keep their SQL text, not a plan, so each
        query sees the newest version; a table replaced by one with other columns needs the call again, and a
        dropped table reads as empty."""
        names = []
        for t in self.current()["tables"]:
            self.spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{prefix}{t}` AS {self.live_sql(t)}")
            names.append(f"{prefix}{t}")
        return names

    # -- writing ---------------------------------------------------------
    def _bucket(self, table: str, buckets: int):
        spec = self.specs.get(table)
        if spec is None or buckets <= 1:
            return F.lit(0)
        return F.pmod(F.xxhash64(*[F.col(k) for k in spec.primary_key]), F.lit(buckets)).cast("int")

    def _write(self, table: str, df: DataFrame, folder: str, buckets: int) -> None:
        """A rebalancing exchange on the bucket before ``partitionBy``: every task writes to few
        buckets, and AQE makes as many tasks of a bucket as its size asks for."""
        out = df.withColumn(BUCKET, self._bucket(table, buckets)).hint("rebalance", F.col(BUCKET))
        out.write.mode("error").partitionBy(BUCKET).parquet(self._path(table, folder))

    def _ordered(self, names):
        return [t for t in LOAD_ORDER if t in names] + [t for t in names if t not in LOAD_ORDER]

    def _whole(self, table: str, df: DataFrame, folder: str, buckets: int) -> dict:
        """Write ``df`` as the only layer of ``table``; the table's new manifest entry."""
        self._write(table, df, folder, buckets)
        return {"schema": df.schema.json(), "buckets": buckets, "owners": [folder] * buckets}

    def _defaulted(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Declared defaults fill absent columns and nulls before anything is written."""
        return {n: with_defaults(df, self.specs[n]) if n in self.specs else df for n, df in tables.items()}

    def publish(self, new_tables: dict[str, DataFrame], check: bool = True,
                batches: dict[str, DataFrame] | None = None) -> dict:
        """M4/M7: write whole new versions of ``new_tables``, check, then publish.

        With ``batches`` only those rows are checked (see ``_check``); without
        it the whole staged state is checked.  The tables are replaced by what the caller made of an
        older version, so a table that another writer changed meanwhile is a ``ConflictError``.
        """
        new_tables = self._defaulted(new_tables)

        def stage(base, folder):
            return {n: (self._whole(n, new_tables[n], folder, self.buckets), None) for n in self._ordered(new_tables)}

        return self._load(stage, (lambda staged: self._check(staged, batches)) if check else None, retries=0)

    def publish_upserts(self, batches: dict[str, DataFrame], check: bool = True) -> dict:
        """M1 + M4: merge each batch by primary key, rewriting only the buckets it
        touches; all tables of the call become visible together or not at all.  Writers may run side by side."""
        batches = self._defaulted(batches)
        for name, b in batches.items():
            check_batch_keys(b, self.specs[name].primary_key, name)  # M2

        def stage(base, folder):
            changes = {}
            for name in self._ordered(batches):
                b, entry = batches[name], base["tables"].get(name)
                if entry is None:
                    changes[name] = (self._whole(name, b, folder, self.buckets), None)
                    continue
                buckets = entry["buckets"]
                bucket = self._bucket(name, buckets)
                b = b.select(*T.StructType.fromJson(json.loads(entry["schema"])).names)
                # touched buckets: at most ``buckets`` small ints reach the driver
                touched = sorted(r[0] for r in b.select(bucket.alias("b")).distinct().collect())
                current_part = self._read_entry(name, entry).where(bucket.isin(touched))
                self._write(name, upsert(current_part, b, self.specs[name].primary_key, check_keys=False), folder, buckets)
                owners = [folder if i in set(touched) else o for i, o in enumerate(entry["owners"])]
                changes[name] = (dict(entry, owners=owners), touched)
            return changes

        return self._load(stage, (lambda staged: self._check(staged, batches)) if check else None)

    def compact(self, table: str, buckets: int | None = None) -> dict:
        """Write ``table`` anew as one layer, in ``buckets`` buckets if given; the content stays."""
        def stage(base, folder):
            entry = base["tables"][table]
            return {table: (self._whole(table, self._read_entry(table, entry), folder, buckets or entry["buckets"]), None)}

        return self._load(stage)

    def _check(self, staged: dict, batches: dict[str, DataFrame] | None) -> None:
        """Batch-scoped: NOT NULL, CHECK, batch-key uniqueness, FKs against the
        staged parents, UNIQUE values against the staged rows holding them --
        all an upsert of a checked batch can break.  Otherwise: everything."""
        state = {t: self._read_entry(t, e) for t, e in staged.items()}
        if batches:
            report = integrity_report(batches, {k: s for k, s in self.specs.items() if k in batches},
                                      parents=state)
            for name, b in batches.items():
                spec = self.specs.get(name)
                for u in (spec.unique if spec else []):
                    if u == spec.primary_key:
                        continue
                    sub = state[name].join(b.select(*u), u, "left_semi")  # semi join: no distinct needed
                    d = duplicate_keys(sub, name, u, "unique_" + "_".join(u))
                    report = report.unionByName(
                        d.agg(F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).cast("long")
                              .alias("violations"))
                        .select(F.lit(name).alias("table_name"),
                                F.lit("unique_" + "_".join(u) + "_staged").alias("constraint_name"),
                                "violations", F.lit("FAIL").alias("status")))
        else:
            report = integrity_report(state, {k: s for k, s in self.specs.items() if k in state})
        bad = report.where(F.col("violations") > 0).collect()
        if bad:
            raise IntegrityError("; ".join(f"{r['table_name']}.{r['constraint_name']}="
                                           f"{r['violations']}" for r in bad))

    def drop(self, table: str) -> dict:
        """M7: a new version without ``table`` (files of old versions stay)."""
        if not self.exists(table):
            cur = self.current()
            return {"version": cur["version"], "tables": sorted(cur["tables"])}
        return self._load(lambda base, folder: {table: (None, None)})

    def diagnostics(self, expected_columns: dict[str, list[str]] | None = None) -> DataFrame:
        """M8 for the warehouse: (check_name, violations, status) rows for the
        expected tables (E2), their columns (E1), every declared constraint on
        the current state, and parent -> child navigation (clubs that have no
        standing row, players pointing to no club)."""
        from terrace.schemas import CLEAN_COLUMNS
        expected_columns = expected_columns or CLEAN_COLUMNS
        tables = self.tables()
        rows = [(f"table_exists:{t}", 0 if t in tables else 1) for t in expected_columns]
        rows += [(f"columns:{t}", len([c for c in cols if c not in tables[t].columns]))
                 for t, cols in expected_columns.items() if t in tables]
        out = self.spark.createDataFrame(rows, "check_name string, violations long")
        present = {k: s for k, s in self.specs.items() if k in tables}
        if present:
            rep = integrity_report(tables, present).select(
                F.concat_ws(":", F.lit("constraint"), "table_name", "constraint_name").alias("check_name"),
                "violations")
            out = out.unionByName(rep)
        if "clubs" in tables and "standings" in tables:
            nav = tables["clubs"].join(tables["standings"].select("club_id"), "club_id", "left_anti") \
                .agg(F.count(F.lit(1)).alias("violations")) \
                .select(F.lit("navigation:clubs_without_standing").alias("check_name"), "violations")
            out = out.unionByName(nav)
        return out.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
