"""Small literal inputs."""

import datetime
import json

from pulselake import schemas

EPOCH = datetime.datetime(1970, 1, 1)


def seconds(text):
    return int((datetime.datetime.fromisoformat(text) - EPOCH).total_seconds())


def meta(activity=20683, latitude=1.5, longitude=-2.5):
    return json.dumps({"activity_id": activity, "location": {"latitude": latitude, "longitude": longitude}})


def raw_events(spark, rows):
    """rows: (event_id, user_id, heart_rate, ISO time, meta)"""
    return spark.createDataFrame(
        [(e, u, h, None if t is None else seconds(t), m) for e, u, h, t, m in rows],
        schemas.RAW_HEART_RATE_WITH_ID)


def raw_users(spark, rows):
    """rows: dicts with the columns that matter; the rest get plain values."""
    plain = {"userid": 10001, "fname": "Ann", "lname": "Lee", "dob": 19840229, "sex": "F", "height": 170,
             "weight": 60, "blood_type": "A+", "race": "W", "origin_country_code": "US",
             "origin_country_name": "United States", "address": "1 Road, Town",
             "address_country_code": "GB", "address_country_name": "United Kingdom",
             "last_update": "2024-10-28T12:08:02Z"}
    return spark.createDataFrame([tuple({**plain, **r}.values()) for r in rows], schemas.RAW_USER)


def raw_activities(spark, rows=((20683, "Run"), (20470, "Sit"))):
    return spark.createDataFrame([(i, n, "2024-10-28T12:08:02Z") for i, n in rows], schemas.RAW_ACTIVITY)
