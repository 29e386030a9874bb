"""Fixed file schemas. Column names and types must match the files."""

from __future__ import annotations

PROVIDER_HISTORY = (
    "tin bigint, mpin bigint, tinname string, healthcareorganizationname string, providersyskey int, "
    "health_system_id string, pcorname string, claimsthrudate string"
)

PROVIDER_DELTA = (
    "tin bigint, mpin bigint, tinname string, healthcareorganizationname string, "
    "health_system_id string, pcorname string, claimsthrudate string"
)

PCOR = (
    "claims_thru_dt string, Health_System_ID string, Health_System_Name string, "
    "Total_Provider_Group_Count int, Total_Patient_Count int, Total_Diabetic_Patients int, "
    "Total_ACVs int, Total_Diabetic_ACVs int, Average_Star_Rating double, "
    "`1_Star_Measure_Count` int, `2_Star_Measure_Count` int, `3_Star_Measure_Count` int, "
    "`4_Star_Measure_Count` int, `5_Star_Measure_Count` int"
)

USER_ASSOCIATION = "Providersyskey int, Healthcareorganizationname string, userID string, roles string"
