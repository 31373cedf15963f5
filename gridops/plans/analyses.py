"""The exploratory analyses as Spark SQL over the models' views (``ModelGraph.register_views``).

``{v}`` is the views' prefix. The point looked at is number 1 of region 1, by its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridops.plans.graph import ModelGraph

POINT = "md5('1-1')"
REGION = "Supplier#000000003"

ANALYSES = {
    # how large the raw tables are, and what they cover
    "sql_coverage": """
        SELECT 'raw_hourly' AS source, count(*) AS total, count(DISTINCT point_no) AS points, count(DISTINCT region_name) AS regions FROM {v}raw_hourly
        UNION ALL SELECT 'raw_daily', count(*), count(DISTINCT point_no), count(DISTINCT region_name) FROM {v}raw_daily
        UNION ALL SELECT 'grid_points', count(*), count(DISTINCT point_no), count(DISTINCT region_name) FROM {v}grid_points
        UNION ALL SELECT 'regions', count(*), 0L, count(DISTINCT region_name) FROM {v}regions""",
    # regions of the seed that no hourly reading is from; a seed row without a name only if no
    # reading has one (as NOT IN reads, which is always a broadcast of all readings' names)
    "sql_missing_regions": """
        SELECT r.region_name, count(r.region_name) AS total FROM {v}regions r
        LEFT ANTI JOIN (SELECT DISTINCT region_name FROM {v}raw_hourly) h ON r.region_name = h.region_name
        WHERE r.region_name IS NOT NULL OR NOT EXISTS (SELECT 1 FROM {v}raw_hourly WHERE region_name IS NOT NULL)
        GROUP BY r.region_name""",
    # one point's indicators by hour
    "sql_point_generation": """
        SELECT grid_point_id, region_id, date_id, hour_id, solar_score, wind_score, kpi_potential_score
        FROM {v}kpi_generation_potential WHERE grid_point_id = {point} ORDER BY date_id, hour_id""",
    "sql_point_stability": """
        SELECT grid_point_id, region_id, date_id, hour_id, pct_drop_from_clear_sky, grid_stability_risk, generator_activation_recommended
        FROM {v}kpi_grid_stability WHERE grid_point_id = {point} ORDER BY date_id, hour_id""",
    # air quality readings that staging holds more than once
    "sql_duplicates": """
        SELECT ts, region_name, point_no, count(*) AS n FROM {v}stg_air_quality
        GROUP BY ALL HAVING count(*) > 1 ORDER BY n DESC, ts, region_name, point_no LIMIT 10""",
    # the points of a region, and its rows in the seed
    "sql_fanout": """
        SELECT 'dim_grid_point' AS source, region_id, region_name, count(*) AS n FROM {v}dim_grid_point WHERE region_name = '{region}' GROUP BY ALL
        UNION ALL SELECT 'regions', region_id, region_name, count(*) FROM {v}regions WHERE region_name = '{region}' GROUP BY ALL""",
}


def run(g: ModelGraph, name: str, prefix: str = "") -> DataFrame:
    """An analysis over the graph's views."""
    g.register_views(prefix)
    return g.spark.sql(ANALYSES[name].format(v=prefix, point=POINT, region=REGION))
