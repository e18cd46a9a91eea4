"""emporium: marketplace ELT and warehouse analytics expressed as Spark jobs.

Layout
------
- ``sources``   -- source registry, CSV extract, the warehouse catalog (create/load/list/export)
                   and the adapter that derives the nine marketplace sources from the driver tables.
- ``functions`` -- column expressions (text normalisation, timestamps, safe arithmetic).
- ``operators`` -- reusable DataFrame operators (first-per-key, duplicates, profiling,
                   exact distributed quantiles, data-quality gates, guarded joins).
- ``plans``     -- entity cleaning pipelines, the two warehouse views, the measure layer and
                   the end-to-end ELT job.
- ``streaming`` -- intentionally empty: the source project has no streaming workload.
"""

__all__ = ["schema", "session"]
