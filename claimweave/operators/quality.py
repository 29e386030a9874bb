"""Quality scores attached to provider systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Published name of each column of the quality file.
RENAMED = {
    "claims_thru_dt": "ReportingPeriod",
    "providersyskey": "ProviderSysKey",
    "Total_Provider_Group_Count": "TotalProviderGroupCount",
    "Total_Patient_Count": "TotalPatientCount",
    "Total_Diabetic_Patients": "TotalDiabeticPatients",
    "Total_ACVs": "TotalACVs",
    "Total_Diabetic_ACVs": "TotalDiabeticACVs",
    "Average_Star_Rating": "AverageStarRating",
    "1_Star_Measure_Count": "1StarMeasureCount",
    "2_Star_Measure_Count": "2StarMeasureCount",
    "3_Star_Measure_Count": "3StarMeasureCount",
    "4_Star_Measure_Count": "4StarMeasureCount",
    "5_Star_Measure_Count": "5StarMeasureCount",
}


def pcor_extract(pcor: DataFrame, lookup: DataFrame) -> DataFrame:
    """Distinct quality rows per provider system with the same health system ID.

    Both sides are made distinct before the join: a health system has as many
    lookup rows as tax IDs, and joining them first would multiply every quality
    row by that number only to remove the copies again. Distinct sides give
    distinct pairs, so nothing is left to remove afterwards.
    """
    systems = lookup.select(F.col("health_system_id").alias("_system"), "providersyskey").distinct()
    rows = pcor.distinct().join(systems, F.col("Health_System_ID") == F.col("_system"))
    return rows.select(*[F.col(f"`{old}`").alias(new) for old, new in RENAMED.items()])
