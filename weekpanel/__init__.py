"""weekpanel: DataFrame operators that turn dated event lists into a dense
unit x week panel and analyse it on Spark.

Sub-packages
------------
sources    scans and sinks (CSV case lists, panel tables, model directories,
           adapters over the benchmark tables)
functions  column expressions (text folding, the week calendar, scalar maths)
operators  DataFrame -> DataFrame operators (cleaning, panel, features, labels,
           EDA, audits, profiles, clustering, metrics, models, forecasting,
           extension, keyed-table changes, scenarios)
plans      composed plans (the master panel) and the registered query catalog
streaming  (empty on purpose: the reference has no streaming operators)
"""

from weekpanel.params import Params

__all__ = ["Params"]
