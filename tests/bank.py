"""A tiny bank with every edge the layers know: no label, two reports, unknown country, unknown customer."""

import datetime as dt

SEEN = dt.datetime(2024, 1, 1)

TRANSACTION = (
    "id string, customer_id string, step long, amount double, type string, nameOrig string, nameDest string, "
    "oldBalanceOrig double, newBalanceOrig double, oldBalanceDest double, newBalanceDest double, "
    "countryOrig string, countryDest string, isUnauthorizedOverdraft int, seen_at timestamp_ntz, _rescued_data string"
)
TRANSACTIONS = [
    ("t1", "c1", 1, 60.0, "PAY", "A", "B", 100.0, 40.0, 0.0, 60.0, "FR--A", "--USA", 0, SEEN, None),
    ("t2", "c1", 2, 10.0, "PAY", "A", "B", 100.0, 90.0, 5.0, 15.0, "FRA", "FRA", 0, SEEN, None),
    ("t3", "c2", 3, 70.0, "MOVE", "C", "B", 0.0, 0.0, 1.0, 71.0, "USA", "FRA--", 1, SEEN, None),
    ("t4", "c2", 4, 5.0, "MOVE", "C", "D", 10.0, 5.0, None, 5.0, "USA", "XXX", 0, SEEN, None),
    ("t5", "c9", 5, 50.0, "MOVE", "C", "D", 50.0, 0.0, 0.0, 50.0, "USA", "FRA", 0, SEEN, None),
]
REPORT = "id string, is_fraud string, _rescued_data string"
REPORTS = [("t1", "1", None), ("t2", "0", None), ("t2", "1", None), ("t9", "1", None)]
COUNTRY = "alpha3_code string, country string, long_avg double, lat_avg double"
COUNTRIES = [("FRA", "France", 2.0, 46.0), ("USA", "United States", -97.0, 38.0)]
CUSTOMER = "id string, firstname string, lastname string, address string, country string, age_group double, _rescued_data string"
CUSTOMERS = [
    ("c1", "Ann", "Lee", "1 Main St\nSpringfield, \"Unit\" 2", "FRA", 3.0, None),
    ("c2", "Bo", "Day", "2 Side St", "USA", 6.0, None),
]


def frames(spark):
    return (
        spark.createDataFrame(TRANSACTIONS, TRANSACTION),
        spark.createDataFrame(REPORTS, REPORT),
        spark.createDataFrame(COUNTRIES, COUNTRY),
        spark.createDataFrame(CUSTOMERS, CUSTOMER),
    )
