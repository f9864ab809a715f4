"""obsflow: a Spark-native engine for collections of dated numeric series.

Layers:

* ``sources``   – landing-zone scans, series catalogs, dimension seeds, test-data adapters
* ``functions`` – column expressions (value coercion, date grammar, safe division, path codecs)
* ``operators`` – payload flattening, keyed upsert, per-series window analytics
* ``plans``     – served views, calendars, backfill planning, health reports
* ``streaming`` – file-arrival incremental load with Structured Streaming

Everything is expressed with DataFrame / SQL primitives so that Catalyst plans it; the
only Python that runs inside tasks is the create-only landing writer and its per-path
existence check.
"""

from obsflow.session import configure, scratch_dir

__all__ = ["configure", "scratch_dir"]
