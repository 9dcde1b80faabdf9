"""Hand-made trips."""

from datetime import datetime

from farelens.sources.schemas import RAW_TRIP

GOOD = {
    "VendorID": 2,
    "lpep_pickup_datetime": datetime(2026, 4, 10, 8, 0, 0),
    "lpep_dropoff_datetime": datetime(2026, 4, 10, 8, 30, 0),
    "store_and_fwd_flag": "N",
    "RatecodeID": 1,
    "PULocationID": 1,
    "DOLocationID": 12,
    "passenger_count": 1,
    "trip_distance": 3.0,
    "fare_amount": 10.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "ehail_fee": None,
    "improvement_surcharge": 1.0,
    "total_amount": 17.25,
    "payment_type": 1,
    "trip_type": 1,
    "congestion_surcharge": 2.75,
    "cbd_congestion_fee": 0.0,
}


def trips(spark, *changes):
    """One trip per dict of changes to a good trip."""
    rows = [{**GOOD, **change} for change in changes]
    return spark.createDataFrame([tuple(r[f] for f in RAW_TRIP.fieldNames()) for r in rows], RAW_TRIP)
