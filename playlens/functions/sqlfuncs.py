"""SQL faces of the column rules, for users who write ``spark.sql``."""

from pyspark.sql import SparkSession

_FUNCTIONS = {
    "season_of": "season_of(m INT) RETURNS STRING RETURN "
    "CASE WHEN m BETWEEN 3 AND 5 THEN 'Summer' WHEN m BETWEEN 6 AND 9 THEN 'Monsoon' ELSE 'Winter' END",
    "daypart_of": "daypart_of(h DOUBLE) RETURNS STRING RETURN "
    "CASE WHEN h >= 5 AND h < 12 THEN 'Morning' WHEN h >= 12 AND h < 17 THEN 'Afternoon' "
    "WHEN h >= 17 AND h < 19.5D THEN 'Evening' WHEN h >= 19.5D AND h < 24 THEN 'Night' ELSE 'Midnight' END",
    "risk_tier_of": "risk_tier_of(p DOUBLE) RETURNS STRING RETURN "
    "CASE WHEN p >= 0.776D THEN 'CRITICAL' WHEN p >= 0.45D THEN 'HIGH' WHEN p >= 0.35D THEN 'MODERATE' ELSE 'SAFE' END",
    "format_duration": "format_duration(s BIGINT) RETURNS STRING RETURN "
    "CASE WHEN s < 60 THEN concat(s, 's') WHEN s < 3600 THEN concat(s div 60, 'm ', s % 60, 's') "
    "WHEN s < 86400 THEN concat(s div 3600, 'h ', s div 60 % 60, 'm ', s % 60, 's') "
    "WHEN s < 2592000 THEN concat(s div 86400, 'd ', s div 3600 % 24, 'm') "
    "WHEN s < 31104000 THEN concat(s div 2592000, 'mo ', s div 86400 % 30, 'd ', s div 3600 % 24, 'h') "
    "ELSE concat(s div 31104000, 'y ', s div 2592000 % 12, 'm ', s div 86400 % 30, 'd') END",
}


def register(spark: SparkSession) -> list[str]:
    for body in _FUNCTIONS.values():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
    return sorted(_FUNCTIONS)
