"""The same queries as plain SQL over the sample tables, written independently of the plans.

Money and measures are integer units throughout, so that sums and roundings are exact and equal
in every engine. Remainders of a key (``k % 37``) say where the sample views put missing, blank,
padded or bad values into the whole tables; they never choose a subset.
"""

from __future__ import annotations

_CANCELLED = "o_orderstatus = 'P'"
_REQUESTED = "(o_orderdate + (k % 1380) * INTERVAL '1' MINUTE)"
_PICKED_UP = "(o_orderdate + (k % 1380 + 3 + k % 10) * INTERVAL '1' MINUTE)"
_DROPPED = "(o_orderdate + (k % 1380 + 20 + k % 40) * INTERVAL '1' MINUTE)"
_FORMAT = "'%Y-%m-%d %H:%M:%S'"
_PLACE = "CASE WHEN k % 11 = 0 THEN '  ' || lower(n_name) || ' ' ELSE n_name END"

_SOURCE = """
source AS (
  SELECT o.*, o.o_orderkey AS k, o.o_custkey AS u, c.*, n.*
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

_TRIPS = f"""{_SOURCE},
trips AS (
  SELECT
    k AS trip_id,
    CASE WHEN k % 37 = 0 THEN NULL WHEN k % 37 = 1 THEN '' ELSE 'D' || u END AS driver_id,
    CASE WHEN k % 41 = 0 THEN NULL WHEN k % 41 = 1 THEN '' ELSE c_name END AS driver_name,
    'R' || (u % 400) AS rider_id,
    n_name AS pickup_city,
    {_PLACE} AS pickup_location,
    n_name AS dropoff_city,
    {_PLACE} AS dropoff_location,
    {_REQUESTED} AS request_time,
    CASE WHEN k % 59 = 0 THEN 'bad' ELSE strftime({_REQUESTED}, {_FORMAT}) END AS request_text,
    strftime({_PICKED_UP}, {_FORMAT}) AS pickup_text,
    CASE WHEN {_CANCELLED} THEN '' ELSE strftime({_DROPPED}, {_FORMAT}) END AS dropoff_text,
    CAST(floor(o_totalprice / 1500) AS DOUBLE) / 10 AS distance_km,
    CASE WHEN k % 53 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS cents,
    CASE WHEN k % 53 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS DOUBLE) / 100 END
      AS fare_amount,
    CAST(CASE k % 5 WHEN 0 THEN 1.2 WHEN 1 THEN 1.5 ELSE 1.0 END AS DOUBLE) AS surge_multiplier,
    CASE WHEN k % 29 = 0 THEN NULL ELSE o_orderpriority END AS payment_type,
    CASE WHEN {_CANCELLED} THEN 'cancelled' ELSE 'completed' END AS trip_status,
    CASE WHEN {_CANCELLED} OR k % 43 = 0 THEN NULL ELSE 32 + (u + k) % 19 END AS tenths,
    CASE WHEN {_CANCELLED} OR k % 43 = 0 THEN NULL
      ELSE CAST(32 + (u + k) % 19 AS DOUBLE) / 10 END AS rating,
    c_mktsegment AS vehicle_type
  FROM source
)"""


def _ratio(total: str, count: str, places: int, digits: int) -> str:
    """``total`` units of ``10**-places`` over ``count``, rounded half away from zero."""
    up, down = 10 ** max(digits - places, 0), 10 ** max(places - digits, 0)
    n, d = f"(({total}) * {up})", f"(({count}) * {down})"
    sign = f"CASE WHEN {n} < 0 THEN -1 ELSE 1 END"
    half_up = f"(2 * abs({n}) + {d}) // (2 * {d})"
    return f"CAST({sign} * ({half_up}) AS DOUBLE) / {10**digits}"


def _avg(unit: str, places: int, digits: int) -> str:
    return _ratio(f"SUM({unit})", f"COUNT({unit})", places, digits)


def _sum(unit: str, places: int = 2) -> str:
    return f"CAST(SUM({unit}) AS DOUBLE) / {10**places}"


def _pct(part: str) -> str:
    return _ratio(f"({part}) * 100", "COUNT(*)", 0, 1)


def _tally(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 END) AS BIGINT)"


def _flagged(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def _count(condition: str) -> str:
    return f"COUNT(CASE WHEN {condition} THEN 1 END)"


_DONE = "trip_status = 'completed'"
_LOST = "trip_status = 'cancelled'"

_SILVER_TRIPS = f"""{_TRIPS},
filled AS (
  SELECT * EXCLUDE (cents),
    coalesce(cents, (SELECT CAST((2 * SUM(cents) + COUNT(cents)) // (2 * COUNT(cents)) AS BIGINT)
                     FROM trips)) AS cents
  FROM trips
),
silver AS (
  SELECT
    trip_id, driver_id, driver_name, rider_id, pickup_city,
    trim(pickup_location) AS pickup_location, dropoff_city,
    trim(dropoff_location) AS dropoff_location,
    CAST(try_strptime(request_text, {_FORMAT}) AS TIMESTAMP) AS request_time,
    CAST(try_strptime(pickup_text, {_FORMAT}) AS TIMESTAMP) AS pickup_time,
    CAST(try_strptime(dropoff_text, {_FORMAT}) AS TIMESTAMP) AS dropoff_time,
    distance_km,
    CAST(cents AS DOUBLE) / 100 AS fare_amount,
    surge_multiplier,
    coalesce(payment_type, 'unknown') AS payment_type,
    trip_status,
    coalesce(rating, 0.0) AS rating,
    vehicle_type,
    CASE WHEN cents < 100000 THEN 'budget' WHEN cents <= 200000 THEN 'standard'
      ELSE 'premium' END AS fare_category,
    CAST((2 * cents + 1500) // 3000 AS DOUBLE) / 100 AS fare_in_usd,
    CASE WHEN coalesce(driver_id, '') = '' OR coalesce(driver_name, '') = ''
      THEN 'incomplete' ELSE 'ok' END AS data_quality,
    cents, (2 * cents + 1500) // 3000 AS usd_cents,
    CASE WHEN rating > 0 THEN tenths END AS tenths,
    CAST(round(surge_multiplier * 10) AS BIGINT) AS surge_tenths,
    CAST(round(distance_km * 10) AS BIGINT) AS km_tenths
  FROM filled
)"""
_WORK = "EXCLUDE (cents, usd_cents, tenths, surge_tenths, km_tenths)"

_CLEAN = f"""{_TRIPS},
numbered AS (
  SELECT *, CASE WHEN trip_id % 47 = 0 THEN NULL ELSE cents END AS read_cents FROM trips
),
clean AS (
  SELECT
    CAST(trip_id AS VARCHAR) AS trip_id, driver_id, driver_name, rider_id, pickup_city,
    pickup_location, dropoff_city, dropoff_location, request_text AS request_time,
    pickup_text AS pickup_time, dropoff_text AS dropoff_time, distance_km,
    coalesce(CAST(read_cents AS DOUBLE) / 100,
      (SELECT CAST(SUM(read_cents) AS DOUBLE) / CAST(COUNT(read_cents) * 100 AS DOUBLE)
       FROM numbered)) AS fare_amount,
    surge_multiplier, coalesce(payment_type, 'unknown') AS payment_type, trip_status,
    coalesce(rating, 0.0) AS rating, vehicle_type,
    CASE WHEN driver_id IS NULL OR driver_name IS NULL THEN 'incomplete' ELSE 'ok' END
      AS data_quality
  FROM numbered
)"""

_EXPORTED = f"""{_TRIPS},
exported AS (
  SELECT CAST(trip_id AS VARCHAR) AS trip_id, driver_id, driver_name, rider_id, pickup_city,
    pickup_location, dropoff_city, dropoff_location, request_text AS request_time,
    pickup_text AS pickup_time, dropoff_text AS dropoff_time, distance_km,
    CASE WHEN trip_id % 47 = 0 THEN 'n/a' ELSE CAST(fare_amount AS VARCHAR) END AS fare_amount,
    surge_multiplier, payment_type, trip_status, CAST(rating AS VARCHAR) AS rating, vehicle_type
  FROM trips
  UNION ALL
  SELECT {", ".join(["NULL"] * 18)} FROM trips WHERE trip_id % 73 = 0
)"""

_ADMISSIONS = f"""{_SOURCE},
bronze AS (
  SELECT
    k AS admission_id,
    CASE WHEN k % 97 = 0 THEN NULL ELSE ' ' || c_name || '  ' END AS patient_name,
    CASE WHEN u % 101 = 0 THEN NULL ELSE CAST(u % 90 AS INTEGER) END AS age,
    CASE WHEN u % 2 = 0 THEN 'Female' ELSE ' male ' END AS gender,
    CASE u % 4 WHEN 0 THEN 'a+' WHEN 1 THEN 'B-' WHEN 2 THEN ' O+' ELSE 'AB-' END AS blood_type,
    CASE WHEN k % 7 = 0 THEN ' ' || lower(c_mktsegment) ELSE c_mktsegment END
      AS medical_condition,
    CAST(o_orderdate AS DATE) AS date_of_admission,
    'Dr ' || u AS doctor,
    'Hospital ' || (k % 997) AS hospital,
    n_name AS insurance_provider,
    CASE WHEN k % 61 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS DOUBLE) / 10 - 200 END
      AS billing_amount,
    CAST(101 + k % 400 AS INTEGER) AS room_number,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Emergency' WHEN '2-HIGH' THEN 'urgent '
      ELSE 'Elective' END AS admission_type,
    CASE WHEN k % 71 = 0 THEN NULL
      ELSE CAST(o_orderdate AS DATE) + CAST(k % 32 - 1 AS INTEGER) END AS discharge_date,
    'Med ' || (k % 5) AS medication,
    CASE k % 3 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Abnormal' ELSE 'Inconclusive' END
      AS test_results
  FROM source
)"""

_STAYS = f"""{_ADMISSIONS},
patients AS (
  SELECT admission_id,
    substr(sha256(lower(trim(patient_name))), 1, 16) AS patient_id,
    age,
    CASE WHEN age < 18 THEN 'Paediatric (0-17)' WHEN age < 36 THEN 'Young Adult (18-35)'
      WHEN age < 61 THEN 'Adult (36-60)' ELSE 'Senior (61+)' END AS age_group,
    upper(trim(gender)) AS gender,
    upper(trim(blood_type)) AS blood_type
  FROM bronze
),
stays AS (
  SELECT *,
    CASE WHEN length_of_stay_days IS NULL OR length_of_stay_days < 0 OR cents IS NULL
      THEN 'investigate' ELSE 'ok' END AS data_quality
  FROM (
    SELECT admission_id, upper(trim(medical_condition)) AS medical_condition,
      date_of_admission, doctor, hospital, insurance_provider,
      CAST(round(billing_amount * 100) AS DOUBLE) / 100 AS billing_amount,
      CAST(round(billing_amount * 100) AS BIGINT) AS cents,
      room_number, upper(trim(admission_type)) AS admission_type, discharge_date, medication,
      upper(trim(test_results)) AS test_results,
      CAST(discharge_date - date_of_admission AS INTEGER) AS length_of_stay_days,
      CASE WHEN billing_amount < 5000 THEN 'low' WHEN billing_amount < 20000 THEN 'mid'
        ELSE 'high' END AS billing_category
    FROM bronze
  )
),
joined AS (
  SELECT stays.*, patient_id, age, age_group, gender, blood_type
  FROM stays LEFT JOIN patients USING (admission_id)
)"""

_STAY_MEAN = _avg("length_of_stay_days", 0, 1)
_BILL_MEAN = _avg("cents", 2, 2)
_ABNORMAL = _count("test_results = 'ABNORMAL'")
_EMERGENCY = _count("admission_type = 'EMERGENCY'")
_HIGH = _count("billing_category = 'high'")

_EVENTS = """
bodies AS (SELECT * FROM events WHERE event_id % 47 <> 0 AND event_id % 53 <> 0)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _long(rows: dict[str, str], value: str, source: str) -> str:
    """A row per entry of one-row aggregates."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {sql} AS {value} FROM {source}"
        for name, sql in rows.items()
    )


def _nulls(columns: dict[str, str], source: str) -> str:
    """``columns``: name to the condition under which a value is missing."""
    parts = "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {_count(missing)} AS nulls, "
        f"{_pct(_count(missing))} AS pct FROM {source}"
        for name, missing in columns.items()
    )
    return f"SELECT * FROM ({parts}) WHERE nulls > 0"


def _frequencies(columns: dict[str, str], source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"column\", CAST({sql} AS VARCHAR) AS value, COUNT(*) AS rows "
        f"FROM {source} GROUP BY ALL"
        for name, sql in columns.items()
    )


_TRIP_TEXT = {
    c: f"coalesce(CAST({c} AS VARCHAR), '') = ''"
    for c in (
        "driver_id", "driver_name", "rider_id", "pickup_city", "pickup_location", "dropoff_city",
        "dropoff_location", "payment_type", "trip_status", "vehicle_type",
    )
}
_TRIP_MISSING = {
    **_TRIP_TEXT,
    "trip_id": "trip_id IS NULL",
    "request_time": "coalesce(request_text, '') = ''",
    "pickup_time": "coalesce(pickup_text, '') = ''",
    "dropoff_time": "coalesce(dropoff_text, '') = ''",
    "distance_km": "distance_km IS NULL",
    "fare_amount": "fare_amount IS NULL",
    "surge_multiplier": "surge_multiplier IS NULL",
    "rating": "rating IS NULL",
}
_HOSPITAL = {
    "Name": "patient_name", "Age": "age", "Gender": "gender", "Blood Type": "blood_type",
    "Medical Condition": "medical_condition", "Date of Admission": "date_of_admission",
    "Doctor": "doctor", "Hospital": "hospital", "Insurance Provider": "insurance_provider",
    "Billing Amount": "billing_amount", "Room Number": "room_number",
    "Admission Type": "admission_type", "Discharge Date": "discharge_date",
    "Medication": "medication", "Test Results": "test_results",
}

_GOLD_TRIPS = {
    "gold_driver_performance": f"""
      SELECT driver_id, driver_name, vehicle_type, COUNT(trip_id) AS total_trips,
        {_tally(_DONE)} AS completed_trips, {_tally(_LOST)} AS cancelled_trips,
        {_pct(_tally(_LOST))} AS cancellation_rate_pct,
        {_sum("cents")} AS total_revenue_ngn, {_sum("usd_cents")} AS total_revenue_usd,
        {_avg("cents", 2, 2)} AS avg_fare_ngn, {_avg("tenths", 1, 2)} AS avg_rating
      FROM silver WHERE data_quality = 'ok' GROUP BY driver_id, driver_name, vehicle_type""",
    "gold_city_summary": f"""
      SELECT pickup_city AS city, COUNT(trip_id) AS total_trips,
        {_tally(_DONE)} AS completed_trips,
        {_sum(f"CASE WHEN {_DONE} THEN cents END")} AS total_revenue_ngn,
        {_avg(f"CASE WHEN {_DONE} THEN cents END", 2, 2)} AS avg_fare_ngn,
        {_avg("tenths", 1, 2)} AS avg_rating, COUNT(DISTINCT driver_id) AS active_drivers
      FROM silver GROUP BY pickup_city""",
    "gold_daily_trends": f"""
      SELECT CAST(request_time AS DATE) AS trip_date, COUNT(trip_id) AS total_trips,
        {_tally(_DONE)} AS completed_trips, {_tally(_LOST)} AS cancelled_trips,
        {_sum(f"CASE WHEN {_DONE} THEN cents END")} AS daily_revenue_ngn,
        {_avg(f"CASE WHEN {_DONE} THEN cents END", 2, 2)} AS avg_fare_ngn,
        {_avg("surge_tenths", 1, 2)} AS avg_surge
      FROM silver GROUP BY 1""",
    "gold_payment_breakdown": f"""
      SELECT payment_type, COUNT(trip_id) AS total_trips,
        {_count("fare_category = 'budget'")} AS budget_trips,
        {_count("fare_category = 'standard'")} AS standard_trips,
        {_count("fare_category = 'premium'")} AS premium_trips,
        {_sum("cents")} AS total_revenue_ngn, {_avg("cents", 2, 2)} AS avg_fare_ngn
      FROM silver WHERE {_DONE} GROUP BY payment_type""",
    "gold_vehicle_performance": f"""
      SELECT vehicle_type, COUNT(trip_id) AS total_trips, {_tally(_DONE)} AS completed_trips,
        {_avg("km_tenths", 1, 2)} AS avg_distance_km, {_avg("cents", 2, 2)} AS avg_fare_ngn,
        {_sum("cents")} AS total_revenue_ngn, {_avg("tenths", 1, 2)} AS avg_rating,
        {_avg("surge_tenths", 1, 2)} AS avg_surge
      FROM silver GROUP BY vehicle_type""",
}

_GOLD_STAYS = {
    "gold_admission_summary": f"""
      SELECT medical_condition, admission_type, COUNT(*) AS total_admissions,
        {_STAY_MEAN} AS avg_length_of_stay_days, MIN(length_of_stay_days) AS min_stay_days,
        MAX(length_of_stay_days) AS max_stay_days, {_BILL_MEAN} AS avg_billing_amount,
        {_ABNORMAL} AS abnormal_results_count, {_pct(_ABNORMAL)} AS abnormal_rate_pct
      FROM joined GROUP BY medical_condition, admission_type""",
    "gold_hospital_revenue": f"""
      SELECT hospital, COUNT(*) AS total_admissions, {_sum("cents")} AS total_revenue,
        {_BILL_MEAN} AS avg_billing_amount, {_HIGH} AS high_billing_cases,
        {_count("billing_category = 'mid'")} AS mid_billing_cases,
        {_count("billing_category = 'low'")} AS low_billing_cases,
        {_STAY_MEAN} AS avg_length_of_stay,
        COUNT(DISTINCT medical_condition) AS conditions_treated
      FROM joined GROUP BY hospital ORDER BY total_revenue DESC NULLS LAST, hospital LIMIT 20""",
    "gold_doctor_performance": f"""
      SELECT doctor, COUNT(*) AS total_patients,
        COUNT(DISTINCT medical_condition) AS conditions_treated,
        {_BILL_MEAN} AS avg_billing_amount, {_sum("cents")} AS total_revenue_generated,
        {_STAY_MEAN} AS avg_length_of_stay, {_count("test_results = 'NORMAL'")} AS normal_results,
        {_ABNORMAL} AS abnormal_results,
        {_count("test_results = 'INCONCLUSIVE'")} AS inconclusive_results
      FROM joined GROUP BY doctor ORDER BY total_patients DESC, doctor LIMIT 20""",
    "gold_disease_trends": f"""
      SELECT medical_condition, age_group, COUNT(*) AS total_cases, {_STAY_MEAN} AS avg_stay_days,
        {_BILL_MEAN} AS avg_billing, {_EMERGENCY} AS emergency_admissions,
        {_pct(_EMERGENCY)} AS emergency_rate_pct, {_ABNORMAL} AS abnormal_tests
      FROM joined GROUP BY medical_condition, age_group""",
    "gold_insurance_analysis": f"""
      SELECT insurance_provider, COUNT(*) AS total_claims, {_sum("cents")} AS total_billed,
        {_BILL_MEAN} AS avg_claim_amount, {_HIGH} AS high_cost_claims,
        {_pct(_HIGH)} AS high_cost_rate_pct,
        COUNT(DISTINCT medical_condition) AS conditions_covered,
        {_STAY_MEAN} AS avg_covered_stay_days
      FROM joined GROUP BY insurance_provider""",
}
_BRIEF = {
    "gold_admission_summary": (
        "medical_condition, admission_type, total_admissions, "
        "avg_length_of_stay_days AS avg_length_of_stay, avg_billing_amount, abnormal_rate_pct"
    ),
    "gold_hospital_revenue": (
        "hospital, total_admissions, total_revenue, avg_billing_amount, avg_length_of_stay"
    ),
    "gold_doctor_performance": (
        "doctor, total_patients, conditions_treated, avg_billing_amount, total_revenue_generated"
    ),
    "gold_disease_trends": (
        "medical_condition, age_group, total_cases, avg_stay_days, avg_billing, emergency_rate_pct"
    ),
    "gold_insurance_analysis": (
        "insurance_provider, total_claims, total_billed, avg_claim_amount, high_cost_rate_pct"
    ),
}

# What a table must have as many rows as, and what it holds.
_CHECKED = {
    "bronze/patients": ("orders", "bronze"),
    "bronze/admissions": ("orders", "bronze"),
    "silver/patients": ("orders", "patients"),
    "silver/admissions": ("orders", "stays"),
    "gold/admission_summary": (
        "(SELECT DISTINCT medical_condition, admission_type FROM stays)",
        f"({_GOLD_STAYS['gold_admission_summary']})",
    ),
    "gold/hospital_revenue": (
        "(SELECT DISTINCT hospital FROM stays LIMIT 20)", f"({_GOLD_STAYS['gold_hospital_revenue']})"
    ),
    "gold/doctor_performance": (
        "(SELECT DISTINCT doctor FROM stays LIMIT 20)", f"({_GOLD_STAYS['gold_doctor_performance']})"
    ),
    "gold/disease_trends": (
        "(SELECT DISTINCT medical_condition, age_group FROM joined)",
        f"({_GOLD_STAYS['gold_disease_trends']})",
    ),
    "gold/insurance_analysis": (
        "(SELECT DISTINCT insurance_provider FROM stays)",
        f"({_GOLD_STAYS['gold_insurance_analysis']})",
    ),
}
_TRIPS_CHECKED = {
    "bronze/trips": ("orders", "trips"),
    "silver/trips": ("orders", "silver"),
    "gold/driver_performance": (
        "(SELECT DISTINCT driver_id, driver_name, vehicle_type FROM silver "
        "WHERE data_quality = 'ok')",
        f"({_GOLD_TRIPS['gold_driver_performance']})",
    ),
    "gold/city_summary": (
        "(SELECT DISTINCT pickup_city FROM silver)", f"({_GOLD_TRIPS['gold_city_summary']})"
    ),
    "gold/daily_trends": (
        "(SELECT DISTINCT CAST(request_time AS DATE) FROM silver)",
        f"({_GOLD_TRIPS['gold_daily_trends']})",
    ),
    "gold/payment_breakdown": (
        f"(SELECT DISTINCT payment_type FROM silver WHERE {_DONE})",
        f"({_GOLD_TRIPS['gold_payment_breakdown']})",
    ),
    "gold/vehicle_performance": (
        "(SELECT DISTINCT vehicle_type FROM silver)", f"({_GOLD_TRIPS['gold_vehicle_performance']})"
    ),
}


def _contract(checked: dict[str, tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, expected, actual, expected = actual AS ok FROM "
        f"(SELECT COUNT(*) AS expected FROM {must} AS m), "
        f"(SELECT COUNT(*) AS actual FROM {holds} AS h)"
        for table, (must, holds) in checked.items()
    )


# Fares in units of 1e-5, ratings too.
_FINE = f"""{_TRIPS},
fine AS (
  SELECT *, cents * 1000 + trip_id % 1000 + CASE WHEN trip_id % 3 = 0 THEN 400 ELSE 0 END AS f,
    tenths * 10000 + trip_id % 7 AS r,
    CAST(cents AS DOUBLE) / 100 + CAST(trip_id % 1000 AS DOUBLE) / 100000
      + CASE WHEN trip_id % 3 = 0 THEN 0.004::DOUBLE ELSE 0.0::DOUBLE END AS fine_fare
  FROM trips
)"""

_TRIP_TYPES = (
    "trip_id bigint, driver_id string, driver_name string, rider_id string, pickup_city string, "
    "pickup_location string, dropoff_city string, dropoff_location string, request_time string, "
    "pickup_time string, dropoff_time string, distance_km double, fare_amount double, "
    "surge_multiplier double, payment_type string, trip_status string, rating double, "
    "vehicle_type string"
)
_HOSPITAL_TYPES = (
    "Name string, Age int, Gender string, Blood Type string, Medical Condition string, "
    "Date of Admission date, Doctor string, Hospital string, Insurance Provider string, "
    "Billing Amount double, Room Number int, Admission Type string, Discharge Date date, "
    "Medication string, Test Results string"
)


def _shape(table: str, columns: int, types: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, COUNT(*) AS rows, {columns} AS columns, "
        f"'{types}' AS column_types FROM {source}"
    )


def oracle_sql() -> dict[str, str]:
    sql = {
        "sql_q01_status_revenue": _with(_TRIPS, f"""
            SELECT trip_status, COUNT(*) AS total_trips, {_sum("cents")} AS total_revenue,
              {_avg("cents", 2, 2)} AS average_fare
            FROM trips GROUP BY trip_status"""),
        "sql_q02_busy_drivers": _with(_TRIPS, f"""
            SELECT driver_id, driver_name, COUNT(trip_id) AS total_trips,
              {_sum("cents")} AS total_revenue
            FROM trips WHERE {_DONE} GROUP BY driver_id, driver_name HAVING COUNT(trip_id) > 4"""),
        "sql_q03_trips_per_day": _with(_TRIPS, """
            SELECT CAST(request_time AS DATE) AS trip_date, COUNT(*) AS trip_count
            FROM trips GROUP BY 1"""),
        "sql_q04_clean_locations": _with(_TRIPS, """
            SELECT DISTINCT upper(trim(pickup_location)) AS cleaned_pickup_location
            FROM trips WHERE pickup_location IS NOT NULL"""),
        "sql_q05_unrated": _with(_TRIPS, """
            SELECT trip_id, driver_name, trip_status FROM trips WHERE rating IS NULL"""),
        "sql_q06_fare_band": _with(_TRIPS, """
            SELECT trip_id, fare_amount, CASE WHEN cents < 100000 THEN 'budget'
              WHEN cents BETWEEN 100000 AND 200000 THEN 'standard' ELSE 'premium' END
              AS fare_category
            FROM trips"""),
        "sql_q07_top3_per_driver": _with(_TRIPS, f"""
            SELECT * FROM (
              SELECT driver_name, trip_id, fare_amount,
                CAST(row_number() OVER (PARTITION BY driver_name
                  ORDER BY cents DESC NULLS LAST, trip_id) AS INTEGER) AS fare_rank
              FROM trips WHERE {_DONE})
            WHERE fare_rank <= 3"""),
        "sql_q08_running_revenue": _with(_TRIPS, """
            SELECT trip_id, request_time, fare_amount,
              CAST(SUM(cents) OVER (ORDER BY request_time) AS DOUBLE) / 100 AS cumulative_revenue
            FROM trips"""),
        "sql_q09_high_rated": _with(_TRIPS, """
            SELECT driver_name, CAST(SUM(tenths) AS DOUBLE) / CAST(COUNT(*) * 10 AS DOUBLE)
              AS average_rating, COUNT(*) AS total_trips
            FROM trips WHERE rating IS NOT NULL GROUP BY driver_id, driver_name
            HAVING SUM(tenths) > 43 * COUNT(*)"""),
        "sql_q10_payment_bands": _with(_TRIPS, f"""
            SELECT payment_type, {_count("cents < 100000")} AS budget_trips,
              {_count("cents BETWEEN 100000 AND 200000")} AS standard_trips,
              {_count("cents > 200000")} AS premium_trips
            FROM trips WHERE {_DONE} GROUP BY payment_type"""),
        "trips_bronze_summary": _with(_TRIPS, f"""
            SELECT COUNT(*) AS total_trips, COUNT(DISTINCT driver_id) AS unique_drivers,
              COUNT(DISTINCT pickup_city) AS cities_covered,
              COUNT(DISTINCT vehicle_type) AS vehicle_types,
              {_flagged(_DONE)} AS completed_trips, {_flagged(_LOST)} AS cancelled_trips,
              {_flagged("driver_id IS NULL OR driver_id = ''")} AS missing_driver_rows,
              {_flagged("fare_amount IS NULL")} AS missing_fare_rows
            FROM trips"""),
        "silver_trips": _with(_SILVER_TRIPS, f"SELECT * {_WORK} FROM silver"),
        "trips_silver_summary": _with(_SILVER_TRIPS, f"""
            SELECT COUNT(*) AS total_rows, COUNT(DISTINCT driver_id) AS unique_drivers,
              COUNT(DISTINCT pickup_city) AS cities, {_tally(_DONE)} AS completed_trips,
              {_tally(_LOST)} AS cancelled_trips,
              {_tally("data_quality = 'incomplete'")} AS incomplete_records,
              {_tally("fare_category = 'budget'")} AS budget_trips,
              {_tally("fare_category = 'standard'")} AS standard_trips,
              {_tally("fare_category = 'premium'")} AS premium_trips,
              {_avg("cents", 2, 2)} AS avg_fare_ngn, {_avg("usd_cents", 2, 2)} AS avg_fare_usd
            FROM silver"""),
        "location_padding": _with(_SILVER_TRIPS, _long({
            "pickup_location": _count("length(pickup_location) <> length(trim(pickup_location))"),
            "dropoff_location": _count(
                "length(dropoff_location) <> length(trim(dropoff_location))"),
        }, "padded", "trips") + "\nUNION ALL " + _long({
            "trimmed_pickup_location": _count(
                "length(pickup_location) <> length(trim(pickup_location))"),
            "trimmed_dropoff_location": _count(
                "length(dropoff_location) <> length(trim(dropoff_location))"),
        }, "padded", "silver")),
        "fill_check": _with(_SILVER_TRIPS, f"""
            SELECT {_count("payment_type IS NULL")} AS null_payment,
              {_count("fare_amount IS NULL")} AS null_fare,
              {_count("rating IS NULL")} AS null_rating
            FROM silver"""),
        "clean_trips": _with(_CLEAN, "SELECT * FROM clean"),
        "cleaning_counts": _with(_EXPORTED, f"""
            SELECT COUNT(*) AS rows_before, COUNT(trip_id) AS rows_after,
              COUNT(*) - COUNT(trip_id) AS rows_dropped,
              {_count("trip_id IS NOT NULL AND (driver_id IS NULL OR driver_name IS NULL)")}
                AS incomplete_rows
            FROM exported"""),
        "normalised_columns": _with(_EXPORTED, "SELECT * FROM exported"),
        **{name: _with(_SILVER_TRIPS, select) for name, select in _GOLD_TRIPS.items()},
        "gold_row_counts": _with(_SILVER_TRIPS, "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, COUNT(*) AS rows FROM ({select})"
            for name, select in _GOLD_TRIPS.items())),
        "bronze_patients": _with(_ADMISSIONS, """
            SELECT admission_id, patient_name, age, gender, blood_type FROM bronze"""),
        "bronze_admissions": _with(_ADMISSIONS, """
            SELECT * EXCLUDE (patient_name, age, gender, blood_type) FROM bronze"""),
        "silver_patients": _with(_STAYS, "SELECT * FROM patients"),
        "silver_admissions": _with(_STAYS, "SELECT * EXCLUDE (cents) FROM stays"),
        "admissions_with_patients": _with(_STAYS, "SELECT * EXCLUDE (cents) FROM joined"),
        **{name: _with(_STAYS, select) for name, select in _GOLD_STAYS.items()},
        **{f"{name}_brief": _with(_STAYS, f"SELECT {_BRIEF[name]} FROM ({select})")
           for name, select in _GOLD_STAYS.items()},
        "profile_nulls": _with(_TRIPS, _nulls(_TRIP_MISSING, "trips")),
        "profile_nulls_admissions": _with(_ADMISSIONS, _nulls(
            {name: f"{column} IS NULL" for name, column in _HOSPITAL.items()}, "bronze")),
        "profile_distinct": _with(_ADMISSIONS, _long({
            c: f"COUNT(DISTINCT {c})" for c in (
                "gender", "admission_type", "medical_condition", "insurance_provider",
                "test_results", "medication")
        }, "distinct_values", "bronze")),
        "profile_frequencies": _with(_TRIPS, _frequencies({
            c: c for c in ("trip_status", "pickup_city", "vehicle_type", "surge_multiplier")
        }, "trips")),
        "profile_frequencies_admissions": _with(_ADMISSIONS, _frequencies({
            c: c for c in ("admission_type", "medical_condition")}, "bronze")),
        "silver_frequencies": _with(_STAYS, _frequencies(
            {"age_group": "age_group"}, "patients") + "\nUNION ALL " + _frequencies(
            {"billing_category": "billing_category", "data_quality": "data_quality"}, "stays")),
        "profile_shape": _with(_TRIPS, _shape("trips", 18, _TRIP_TYPES, "trips")),
        "profile_shape_admissions": _with(
            _ADMISSIONS, _shape("hospital", 15, _HOSPITAL_TYPES, "bronze")),
        "stay_stats": _with(_STAYS, """
            SELECT MIN(length_of_stay_days) AS min_stay_days,
              MAX(length_of_stay_days) AS max_stay_days,
              CAST(SUM(length_of_stay_days) AS DOUBLE)
                / CAST(COUNT(length_of_stay_days) AS DOUBLE) AS mean_stay_days
            FROM stays"""),
        "validate_row_counts": _with(_STAYS, _contract(_CHECKED)),
        "validate_trip_layers": _with(_SILVER_TRIPS, _contract(_TRIPS_CHECKED)),
        "catalog_insurance_analysis": _with(_STAYS, _GOLD_STAYS["gold_insurance_analysis"]),
        "admission_dates": _with(_SOURCE, """
            SELECT k AS admission_id, CASE WHEN k % 89 = 0 OR k % 83 = 0 THEN NULL
              ELSE CAST(o_orderdate AS DATE) END AS date_of_admission
            FROM source"""),
        "time_reading": _with(_TRIPS, "\nUNION ALL ".join(
            f"SELECT '{name}_time' AS \"column\", "
            f"COUNT(*) FILTER (trim({name}_text) <> '') AS given, "
            f"COUNT(*) FILTER (trim({name}_text) <> '' AND "
            f"try_strptime({name}_text, {_FORMAT}) IS NULL) AS unread FROM trips"
            for name in ("request", "pickup", "dropoff"))),
        "clean_file_records": _with(_CLEAN, """
            SELECT * REPLACE (nullif(driver_id, '') AS driver_id,
              nullif(driver_name, '') AS driver_name, nullif(dropoff_time, '') AS dropoff_time,
              CASE WHEN coalesce(driver_id, '') = '' OR coalesce(driver_name, '') = ''
                THEN 'incomplete' ELSE 'ok' END AS data_quality)
            FROM clean"""),
        "fine_status_revenue": _with(_FINE, f"""
            SELECT trip_status, COUNT(*) AS total_trips, {_sum("f", 5)} AS total_revenue,
              {_avg("f", 5, 2)} AS average_fare
            FROM fine GROUP BY trip_status"""),
        "fine_running_revenue": _with(_FINE, """
            SELECT trip_id, request_time, fine_fare AS fare_amount,
              CAST(SUM(f) OVER (ORDER BY request_time) AS DOUBLE) / 100000 AS cumulative_revenue
            FROM fine"""),
        "fine_high_rated": _with(_FINE, """
            SELECT driver_name, CAST(SUM(r) AS DOUBLE) / CAST(COUNT(*) * 100000 AS DOUBLE)
              AS average_rating, COUNT(*) AS total_trips
            FROM fine WHERE r IS NOT NULL GROUP BY driver_id, driver_name
            HAVING SUM(r) > 430003 * COUNT(*)"""),
        "fine_measure_totals": _with(_TRIPS, """
            SELECT trip_status, CAST(SUM(4 * (1 + trip_id % 5)) AS DOUBLE) / 1e11 AS tiny_sum,
              CAST(SUM(4 * (1 + trip_id % 5)) AS DOUBLE) / 1e11 / COUNT(*) AS tiny_mean,
              CAST(SUM(CASE trip_id % 4 WHEN 1 THEN 1200000000000 WHEN 2 THEN 1 ELSE 0 END)
                AS DOUBLE) / 4 AS spread_sum,
              CAST(SUM(CASE trip_id % 4 WHEN 1 THEN 1200000000000 WHEN 2 THEN 1 ELSE 0 END)
                AS DOUBLE) / 4 / COUNT(*) FILTER (trip_id % 4 < 3) AS spread_mean
            FROM trips GROUP BY trip_status"""),
        "landing_reload": _with(_TRIPS, """
            SELECT 'landed' AS kind, 4 AS batches, COUNT(*) AS trips, SUM(cents) AS cents,
              true AS ok FROM trips
            UNION ALL SELECT 'other', 1, COUNT(*), SUM(cents), true FROM trips
            WHERE trip_id % 7 = 0"""),
        "line_breaks": _with(_TRIPS, """
            SELECT CAST(trip_id AS VARCHAR) AS trip_id, pickup_city,
              CASE WHEN trip_id % 10 = 0 THEN 'said "go",' || chr(10) || chr(10) || pickup_city
                ELSE pickup_location END AS pickup_location, fare_amount
            FROM trips"""),
        "versioned_rebuild": _with(_TRIPS, """
            SELECT 'before' AS state, COUNT(*) AS trips, SUM(cents) AS cents FROM trips
            WHERE trip_status = 'completed'
            UNION ALL SELECT 'after', COUNT(*), SUM(cents) FROM trips"""),
        "landing_late": _with(_TRIPS, """
            SELECT CAST(trip_id AS VARCHAR) AS trip_id, pickup_city, vehicle_type,
              CASE WHEN trip_id % 4 = 1 AND trip_id % 61 = 0 THEN NULL ELSE fare_amount END
                AS fare_amount,
              CASE WHEN trip_id % 4 = 1 AND trip_id % 61 = 0 THEN 'n/a' END AS unread
            FROM trips"""),
        "landing_trips": _with(_TRIPS, """
            SELECT CAST(trip_id AS VARCHAR) AS trip_id, nullif(driver_id, '') AS driver_id,
              nullif(driver_name, '') AS driver_name, rider_id, pickup_city, pickup_location,
              dropoff_city, dropoff_location, request_text AS request_time,
              pickup_text AS pickup_time, nullif(dropoff_text, '') AS dropoff_time, distance_km,
              fare_amount, surge_multiplier, payment_type, trip_status, rating, vehicle_type
            FROM trips"""),
        "stream_trip_events": _with(_EVENTS, """
            SELECT 'EVT' || (1000 + event_id % 9000) AS event_id, event_type,
              'T' || event_id AS trip_id, 'D' || user_id AS driver_id,
              'R' || (user_id % 400) AS rider_id, 'City ' || (user_id % 5) AS city,
              "value" AS fare_amount,
              CASE WHEN event_id % 31 = 0 THEN 'soon'
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
              CASE WHEN event_id % 31 = 0 THEN NULL ELSE ts END AS event_ts
            FROM bodies"""),
        "event_files": _with(_EVENTS, """
            SELECT 'EVT' || (1000 + event_id % 9000) AS event_id, event_type,
              'T' || event_id AS trip_id, 'D' || user_id AS driver_id,
              'R' || (user_id % 400) AS rider_id, 'City ' || (user_id % 5) AS city,
              "value" AS fare_amount,
              CASE WHEN event_id % 31 = 0 THEN 'soon'
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
              CASE WHEN event_id % 31 = 0 THEN NULL ELSE ts END AS event_ts
            FROM bodies"""),
        "stream_quarantine": """
            SELECT 'not json' || event_id AS raw_body FROM events WHERE event_id % 47 = 0""",
    }
    return {name: text.strip() for name, text in sql.items()}
