"""Generic data-quality audit (Q1-Q13) as one pass.

``audit`` evaluates every check for every record (no short-circuit).  Row-level
findings (missing fields, rule results) are flags computed in the scan's
projection; the per-row triage collects them into one ``_rejection_reasons``
array in the reference's order: missing required fields, duplicate key, then
each rule.

First-wins uniqueness (W5) needs a record order, which the caller declares (W6: ingestion
stamps a record index; other inputs order by their columns).  Instead of a window over
the whole key group -- one task per key, fatal when one key holds a third of all rows --
only keys that can matter are looked at: for counting, keys with good and bad rows; for the
per-row outputs, keys with more than one row.  Their first row is found with a
``row_number() = 1`` filter, of which every map task keeps one row per key before the shuffle.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions import scalars as S
from terrace.operators.rows import repeat_rows

#: Place of a record in its batch, stamped at ingestion and kept through bronze.
RECORD_INDEX = "_record_index"

# Status labels and issue message formats (as in the reference's
# issue log): "Missing required field: '<f>'", "Duplicate primary key '<pk>'=<v>",
# "Validation failure: <rule>", "Validator exception: <rule> (...)".
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
MSG_MISSING = "Missing required field: '{}'"
MSG_DUPLICATE = "Duplicate primary key '{}'="
MSG_FAILURE = "Validation failure: {}"
MSG_EXCEPTION = "Validator exception: {} (null or non-numeric input)"
# Fixed value: share of rejected records (pooled over datasets) from which a batch fails.
FAIL_SHARE = 0.1


@dataclass
class Rule:
    """A business rule: ``check`` is a boolean Column.  A null result is the
    reference's "validator raised" branch (e.g. int(None)); false is a failure."""
    description: str
    check: Column


@dataclass
class AuditSpec:
    name: str
    primary_key: str | list[str]
    required: list[str]
    rules: list[Rule] = field(default_factory=list)
    order: list[str] = field(default_factory=list)  # record order (W6), required by ``audit``


class AuditResult:
    """Lazy outputs of one audit.

    ``flags``: every input row with its row-level findings (missing fields,
    rule failures), no shuffle.  Two ways on from there:

    * per-key summary (metrics, issue counts): one partially aggregated
      group-by on the key -- rows and bad rows -- and the first row of the keys that have
      both good and bad ones, which is all the duplicate logic needs for counting;
    * per-row triage (valid, rejected, issue log): the first row of the keys that repeat
      is joined back.
    """

    def __init__(self, name: str, flags: DataFrame, columns: list[str], pk: list[str],
                 missing: list[tuple[str, Column]], rules: list[Rule], persist: bool, index: bool):
        self._index = index
        self.name, self.flags, self.columns, self.pk = name, flags, columns, pk
        self._missing, self._rules, self._persist = missing, rules, persist
        self._audited = None

    # -- per-row path ----------------------------------------------------
    @property
    def audited(self) -> DataFrame:
        if self._audited is None:
            rows = self._with_duplicates()
            dup_msg = F.when(F.col("_is_dup"), F.concat(F.lit(MSG_DUPLICATE.format(",".join(self.pk))),
                                                       _pk_text(self.pk)))
            rule_msgs = [F.when(F.col(f"_r{i}").isNull(), F.lit(MSG_EXCEPTION.format(r.description)))
                         .when(~F.col(f"_r{i}"), F.lit(MSG_FAILURE.format(r.description)))
                         for i, r in enumerate(self._rules)]
            miss_msgs = [F.when(F.col(f"_m{i}"), F.lit(MSG_MISSING.format(f)))
                         for i, (f, _) in enumerate(self._missing)]
            a = rows.select(*self.columns, "_record_index",
                            F.filter(F.array(*miss_msgs, dup_msg, *rule_msgs, F.lit(None).cast("string")),
                                     lambda x: x.isNotNull()).alias("_rejection_reasons"),
                            "_n_missing", "_is_dup", "_n_rule")
            # the one copy that metrics, valid and rejected rows read
            self._audited = a.persist(StorageLevel.MEMORY_AND_DISK) if self._persist else a
        return self._audited

    def _with_duplicates(self) -> DataFrame:
        """Every flagged row with ``_is_dup``: not the first of its key in the record order."""
        repeated = (self.flags.where(_key_ok(self.pk)).groupBy(*self.pk).agg(F.count(F.lit(1)).alias("_c"))
                    .where(F.col("_c") > 1).select(*self.pk))
        rows = self.flags.join(repeated, self.pk, "left_semi")
        firsts = _first_rows(rows, self.pk).select(*self.pk, F.col("_ord").alias("_first"))
        if self._index:
            # an index tells all rows apart
            joined = self.flags.join(firsts, self.pk, "left")
            return joined.withColumn("_is_dup", F.coalesce(F.col("_ord") != F.col("_first"), F.lit(False)))
        # rows that are equal in everything are interchangeable: they are counted, and all but one
        # of those at the first place are duplicates
        counted = rows.groupBy(*self.flags.columns).agg(F.count(F.lit(1)).alias("_n")).join(firsts, self.pk)
        copies = repeat_rows(counted, "_n", "_copy").withColumn("_is_dup", (F.col("_ord") != F.col("_first")) | (F.col("_copy") > 1))
        single = (self.flags.where(_key_ok(self.pk)).join(repeated, self.pk, "left_anti")
                  .unionByName(self.flags.where(~_key_ok(self.pk))).withColumn("_is_dup", F.lit(False)))
        return single.unionByName(copies.select(single.columns))

    @property
    def valid(self) -> DataFrame:
        return self.audited.where(F.size("_rejection_reasons") == 0).select(*self.columns)

    @property
    def rejected(self) -> DataFrame:
        """Q5: original columns + _rejection_reasons + _record_index."""
        return (self.audited.where(F.size("_rejection_reasons") > 0)
                .select(*self.columns, "_rejection_reasons", "_record_index"))

    @property
    def issues(self) -> DataFrame:
        """Q6: one row per issue (record_index, pk, error)."""
        return (self.audited.where(F.size("_rejection_reasons") > 0)
                .select(F.col("_record_index").alias("record_index"), _pk_text(self.pk).alias("pk"),
                        F.explode("_rejection_reasons").alias("error")))

    # -- per-key summary path --------------------------------------------
    def key_summary(self) -> DataFrame:
        """One row per key value: _c rows, _bad rows with a row-level issue,
        _first_bad, _dups (rows after the first; 0 for a null key) and
        _rejected (rows rejected for any reason)."""
        f = self.flags.withColumn("_bad", ((F.col("_n_missing") + F.col("_n_rule")) > 0).cast("long"))
        aggs = [F.count(F.lit(1)).alias("_c"), F.sum("_bad").alias("_bad"),
                F.sum("_n_missing").alias("_n_missing"), F.sum("_n_rule").alias("_n_rule")]
        aggs += [F.sum(F.col(f"_m{i}").cast("long")).alias(f"_m{i}") for i in range(len(self._missing))]
        aggs += [F.count_if(F.col(f"_r{i}").isNull()).alias(f"_rx{i}") for i in range(len(self._rules))]
        aggs += [F.count_if(~F.col(f"_r{i}")).alias(f"_rf{i}") for i in range(len(self._rules))]
        g = f.groupBy(*self.pk).agg(*aggs)
        # the first row decides only where a key has good and bad rows
        mixed = g.where((F.col("_bad") > 0) & (F.col("_bad") < F.col("_c"))).select(*self.pk)
        first = _first_rows(f.join(mixed, self.pk, "left_semi"), self.pk).select(*self.pk, F.col("_bad").alias("_fb"))
        g = g.join(first, self.pk, "left").withColumn(
            "_first_bad", F.when(F.col("_bad") == 0, 0).when(F.col("_bad") == F.col("_c"), 1).otherwise(F.col("_fb"))).drop("_fb")
        key_ok = _key_ok(self.pk)
        dups = F.when(key_ok, F.col("_c") - 1).otherwise(F.lit(0))
        rejected = F.col("_bad") + F.when(key_ok, F.col("_c") - F.col("_bad") - 1 + F.col("_first_bad")) \
            .otherwise(F.lit(0))
        return g.withColumn("_dups", dups).withColumn("_rejected", rejected)

    @property
    def metrics(self) -> DataFrame:
        """One row; counters count issues, rejected counts records."""
        if self._persist:
            a = self.audited
            bad = F.size("_rejection_reasons") > 0
            return a.agg(
                F.lit(self.name).alias("dataset"), F.count(F.lit(1)).alias("source_count"),
                F.count_if(~bad).alias("valid_count"), F.count_if(bad).alias("rejected_count"),
                F.coalesce(F.sum("_n_missing"), F.lit(0)).cast("long").alias("missing_fields_count"),
                F.count_if("_is_dup").alias("duplicate_count"),
                F.coalesce(F.sum("_n_rule"), F.lit(0)).cast("long").alias("validation_error_count"))
        g = self.key_summary()
        return g.agg(
            F.lit(self.name).alias("dataset"),
            F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("source_count"),
            F.coalesce(F.sum(F.col("_c") - F.col("_rejected")), F.lit(0)).cast("long").alias("valid_count"),
            F.coalesce(F.sum("_rejected"), F.lit(0)).cast("long").alias("rejected_count"),
            F.coalesce(F.sum("_n_missing"), F.lit(0)).cast("long").alias("missing_fields_count"),
            F.coalesce(F.sum("_dups"), F.lit(0)).cast("long").alias("duplicate_count"),
            F.coalesce(F.sum("_n_rule"), F.lit(0)).cast("long").alias("validation_error_count"))

    def issue_counts(self) -> DataFrame:
        """Issues per kind (dataset, kind, issue_count); duplicates under one kind."""
        g = self.key_summary()
        kinds = [(MSG_MISSING.format(f), f"_m{i}") for i, (f, _) in enumerate(self._missing)]
        kinds.append(("Duplicate primary key", "_dups"))
        for i, r in enumerate(self._rules):
            kinds.append((MSG_EXCEPTION.format(r.description), f"_rx{i}"))
            kinds.append((MSG_FAILURE.format(r.description), f"_rf{i}"))
        wide = g.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"k{i}")
                       for i, (_, c) in enumerate(kinds)])
        long_ = wide.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"k{i}").alias("n"))
                                                 for i, (k, _) in enumerate(kinds)])).alias("x"))
        return long_.where(F.col("x.n") > 0).select(F.lit(self.name).alias("dataset"),
                                                    F.col("x.kind").alias("kind"),
                                                    F.col("x.n").alias("issue_count"))

    def unpersist(self):
        if self._audited is not None and self._persist:
            self._audited.unpersist()


def _key_ok(pk: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in pk])


def _pk_text(pk: list[str]) -> Column:
    return F.concat_ws(",", *[F.col(k).cast("string") for k in pk]) if len(pk) > 1 \
        else F.col(pk[0]).cast("string")


def _first_rows(rows: DataFrame, pk: list[str]) -> DataFrame:
    """The first row of each key in the record order; every map task sends one row per key."""
    order = Window.partitionBy(*pk).orderBy("_ord")
    return rows.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") == 1).drop("_rn")


def audit(df: DataFrame, name: str, primary_key: str | list[str], required: list[str],
          rules: list[Rule] | None = None, order: list[str] | None = None,
          persist: bool = True) -> AuditResult:
    """Q1-Q7 over ``df``.

    ``order``: the columns that give the record order for first-wins dedup.  Either the
    ``_record_index`` that ingestion stamped, which tells all rows apart, or columns of
    the data: then they should make a total order up to rows that are equal in all columns, which are
    interchangeable.  No row ids are made here: an id made while scanning need not be
    the same in two scans.
    Required fields that are absent from the schema count as missing on every row.
    Nothing runs until an output is used.
    """
    if not order:
        raise ValueError(f"audit of {name!r}: first-wins dedup needs a record order")
    rules = rules or []
    pk = [primary_key] if isinstance(primary_key, str) else list(primary_key)
    index = list(order) == [RECORD_INDEX]
    columns = [c for c in df.columns if c != RECORD_INDEX]
    types = dict(df.dtypes)
    rec = F.col(RECORD_INDEX) if index else F.struct(*[F.col(c) for c in order])
    # key columns are constant inside a key group: leave them out of the comparison key
    within = [c for c in order if c not in pk]
    ordkey = F.col(RECORD_INDEX) if index else F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(within)] or [F.lit(0).alias("o")])
    missing = [(f, F.lit(True) if f not in columns else
                S.is_blank(f) if types[f] == "string" else F.col(f).isNull()) for f in required]
    n_missing = reduce(lambda a, b: a + b, [c.cast("long") for _, c in missing], F.lit(0).cast("long"))
    n_rule = reduce(lambda a, b: a + b, [F.when(F.coalesce(r.check, F.lit(False)), 0).otherwise(1)
                                         for r in rules], F.lit(0)).cast("long")
    flags = df.select(*columns, rec.alias("_record_index"), ordkey.alias("_ord"),
                        *[c.alias(f"_m{i}") for i, (_, c) in enumerate(missing)],
                        *[r.check.alias(f"_r{i}") for i, r in enumerate(rules)],
                        n_missing.alias("_n_missing"), n_rule.alias("_n_rule"))
    return AuditResult(name, flags, columns, pk, missing, rules, persist, index)


def flatten_records(records: DataFrame, fields: list[str], record_col: str = "record") -> DataFrame:
    """Raw ``map<string,string>`` records -> one string column per field plus a
    ``_has_<field>`` flag: an absent key and an explicit null stay different
    (Q1/Q3).  Rules built by ``terrace.schemas`` read the flags."""
    m = F.col(record_col)
    cols = []
    for f in fields:
        cols.append(F.try_element_at(m, F.lit(f)).alias(f))
        cols.append(F.map_contains_key(m, F.lit(f)).alias(f"_has_{f}"))
    return records.select(*cols)


def audit_spec(df: DataFrame, spec: AuditSpec, persist: bool = True) -> AuditResult:
    return audit(df, spec.name, spec.primary_key, spec.required, spec.rules, spec.order, persist)


def quality_report(results: list[AuditResult]) -> DataFrame:
    """Totals over the datasets' metrics rows + status + details.

    Status: no rejected record PASS; fewer than 10 % of the pooled source records
    rejected WARN; otherwise FAIL (exactly 10 % fails).
    """
    per = reduce(DataFrame.unionByName, [r.metrics for r in results])
    tot = per.agg(
        F.sum("source_count").cast("long").alias("source_records"),
        F.sum("valid_count").cast("long").alias("processed_records"),
        F.sum("rejected_count").cast("long").alias("rejected_records"),
        F.sum("missing_fields_count").cast("long").alias("missing_fields"),
        F.sum("duplicate_count").cast("long").alias("duplicates"),
        F.sum("validation_error_count").cast("long").alias("validation_errors"),
        F.sort_array(F.collect_list(F.struct(*per.columns))).alias("dataset_details"))
    return tot.withColumn("status", status_of("rejected_records", "source_records")) \
              .withColumn("timestamp", F.lit(_dt.datetime.now(_dt.timezone.utc).isoformat()))


def status_of(rejected, source) -> Column:
    r, s = S.col_of(rejected), S.col_of(source)
    return (F.when(r == 0, F.lit(PASS))
             .when(r.cast("double") < s.cast("double") * F.lit(FAIL_SHARE), F.lit(WARN))
             .otherwise(F.lit(FAIL)))


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame) -> dict:
    """Q10: one small action on the one-row report; FAIL raises, WARN/PASS continue."""
    row = report.select("status", "rejected_records", "source_records").first().asDict()
    if row["status"] == FAIL:
        raise QualityGateError(
            f"Data quality gate failed: {row['rejected_records']} of {row['source_records']} "
            "records rejected")
    return row


def banner(row: dict, title: str = "LEAGUE DATA QUALITY REPORT") -> str:
    """Q11: fixed text rendering of the one-row report."""
    # Banner labels and layout.
    lines = [
        title,
        "-" * 24,
        f"Source records:       {row['source_records']}",
        f"Processed records:    {row['processed_records']}",
        f"Rejected records:     {row['rejected_records']}",
        f"Missing fields:       {row['missing_fields']}",
        f"Duplicates:           {row['duplicates']}",
        f"Validation errors:    {row['validation_errors']}",
        f"Status:                {row['status']}",
    ]
    return "\n".join(lines)


def require_rows(df: DataFrame, what: str) -> None:
    """Q13: an empty input batch is an error for the cleaners."""
    if df.isEmpty():
        raise ValueError(f"Cannot clean empty {what} records")
