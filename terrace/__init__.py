"""terrace: a Spark-native league analytics pipeline.

Bronze record batches are audited (completeness, key uniqueness, business rules,
quarantine, PASS/WARN/FAIL gate), cleaned, turned into standings, form and
rankings, checked against declarative constraints, merged into versioned tables
and served as DataFrame functions.  Every operator is a DataFrame/Column
composition; nothing is collected to the driver except one-row reports.
"""

__version__ = "0.1.0"
