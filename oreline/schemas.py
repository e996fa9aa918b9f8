"""Schemas and the fixed values of the two subject areas, trips and admissions."""

from __future__ import annotations

# Fixed values. Column names, formats, cut points, labels and literals that stored tables and
# existing queries depend on.

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"

TRIP_COLUMNS = [
    "trip_id", "driver_id", "driver_name", "rider_id", "pickup_city", "pickup_location",
    "dropoff_city", "dropoff_location", "request_time", "pickup_time", "dropoff_time",
    "distance_km", "fare_amount", "surge_multiplier", "payment_type", "trip_status", "rating",
    "vehicle_type",
]
LOCATION_COLUMNS = ["pickup_location", "dropoff_location"]
TIME_COLUMNS = ["request_time", "pickup_time", "dropoff_time"]
DRIVER_COLUMNS = ["driver_id", "driver_name"]

NAIRA_PER_DOLLAR = 1500
MISSING_PAYMENT = "unknown"
MISSING_RATING = 0.0
FARE_BANDS = [("budget", "<", 1000), ("standard", "<=", 2000)]
FARE_TOP_BAND = "premium"
HIGH_RATING = "4.3"
BUSY_DRIVER_TRIPS = 4
TOP_TRIPS_PER_DRIVER = 3

HOSPITAL_TO_PATIENTS = {
    "Name": "patient_name",
    "Age": "age",
    "Gender": "gender",
    "Blood Type": "blood_type",
}
HOSPITAL_TO_ADMISSIONS = {
    "Medical Condition": "medical_condition",
    "Date of Admission": "date_of_admission",
    "Doctor": "doctor",
    "Hospital": "hospital",
    "Insurance Provider": "insurance_provider",
    "Billing Amount": "billing_amount",
    "Room Number": "room_number",
    "Admission Type": "admission_type",
    "Discharge Date": "discharge_date",
    "Medication": "medication",
    "Test Results": "test_results",
}
AGE_BANDS = [
    ("Paediatric (0-17)", "<", 18),
    ("Young Adult (18-35)", "<", 36),
    ("Adult (36-60)", "<", 61),
]
AGE_TOP_BAND = "Senior (61+)"
BILLING_BANDS = [("low", "<", 5000), ("mid", "<", 20000)]
BILLING_TOP_BAND = "high"
PSEUDONYM_HEX_DIGITS = 16
REPORT_ROWS = 20

# End of fixed values.

# Decimal places kept when doubles are summed exactly (functions/exact.py).
MONEY_PLACES = 2
MEASURE_PLACES = 4

# Source schemas, as DDL text.

TRIP_TEXT_SCHEMA = (
    "trip_id string, driver_id string, driver_name string, rider_id string, pickup_city string, "
    "pickup_location string, dropoff_city string, dropoff_location string, request_time string, "
    "pickup_time string, dropoff_time string, distance_km double, fare_amount double, "
    "surge_multiplier double, payment_type string, trip_status string, rating double, "
    "vehicle_type string"
)

HOSPITAL_SCHEMA = (
    "`Name` string, `Age` int, `Gender` string, `Blood Type` string, `Medical Condition` string, "
    "`Date of Admission` date, `Doctor` string, `Hospital` string, `Insurance Provider` string, "
    "`Billing Amount` double, `Room Number` int, `Admission Type` string, "
    "`Discharge Date` date, `Medication` string, `Test Results` string"
)

TRIP_EVENT_SCHEMA = (
    "event_id string, event_type string, trip_id string, driver_id string, rider_id string, "
    "city string, fare_amount double, timestamp string"
)
