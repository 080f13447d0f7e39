"""Literal-row builders for S (work orders), W (dimension) and R (recurring repeats)."""

import datetime as dt
from decimal import Decimal

from recurwork import schemas

AS_OF = dt.date(2001, 8, 2)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def d(s):
    return dt.date.fromisoformat(s)


def wo(tracking_nbr, completion_date, store_nbr=1, trade="FM - HVAC", category="HVAC", ptype="LEAK",
       code="C1", amount="100.00", desc="Unit A", tag="T1", problem_desc=None):
    return (tracking_nbr, store_nbr, trade, category, ptype, code,
            d(completion_date) if isinstance(completion_date, str) else completion_date,
            Decimal(amount) if amount is not None else None, desc, tag,
            problem_desc if problem_desc is not None else f"desc {tracking_nbr}")


def dim(tracking_nbr, director="Dir A", sr="Sr A", rm="Rm A", fsm="Fsm A", city="City", state="ST",
        tech="Tech 1", banner="SC"):
    return (tracking_nbr, city, state, sr, director, rm, fsm, banner, tech)


def s_df(spark, rows):
    return spark.createDataFrame(rows, schemas.WORKORDERS)


def w_df(spark, rows):
    return spark.createDataFrame(rows, schemas.WORKORDER_DIM)


def rec(tracking_nbr, call_date, gap, store_nbr=1, trade="FM - HVAC", tag="E1", code="P1"):
    cd = d(call_date)
    prev = cd - dt.timedelta(days=gap)
    return (tracking_nbr, tracking_nbr - 1, store_nbr, trade, tag, "asset", cd, prev, code, code,
            int(gap <= 90), int(gap <= 180), int(gap <= 365))


def r_df(spark, rows):
    return spark.createDataFrame(rows, schemas.RECURRING)
