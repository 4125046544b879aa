import datetime as dt
from decimal import Decimal

import pytest

from gearledger.session import local_session

SMALL = "/root/testdata/sf0.001"

ORDER_SCHEMA = """id long, order_id long, province string, city string, repair_id long, repair_name string,
  manager_id long, manager_name string, is_b2b string, is_picc string, is_fbj string, payment_type string,
  vehicle_type string, order_status string, order_amount decimal(11,2), purchase_amount decimal(11,2),
  oem_amount decimal(11,2), refund_amount decimal(11,2), refund_purchase_amount decimal(11,2),
  refund_oem_amount decimal(11,2), deliver_date date, refund_date date, payment_date date"""
ORDER_COLUMNS = [c.split()[0] for c in ORDER_SCHEMA.replace("\n", " ").replace("(11,2)", "").split(",")]


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()


def money(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


@pytest.fixture
def orders(spark):
    """Order rows from keyword dictionaries; everything not named has a plain default."""
    def make(*rows):
        out = []
        for i, row in enumerate(rows, 1):
            r = dict(
                id=i, order_id=i, province="P", city="C", repair_id=i, repair_name=f"shop{i}", manager_id=1,
                manager_name="M1", is_b2b="1", is_picc="1", is_fbj="1", payment_type="01", vehicle_type="1",
                order_status="700", order_amount=100, purchase_amount=80, oem_amount=40, refund_amount=None,
                refund_purchase_amount=None, refund_oem_amount=None, deliver_date=None, refund_date=None,
                payment_date="2020-03-01")
            r.update(row)
            for c in ORDER_COLUMNS:
                if c.endswith("_amount"):
                    r[c] = money(r[c])
                elif c.endswith("_date"):
                    r[c] = day(r[c])
            out.append(tuple(r[c] for c in ORDER_COLUMNS))
        return spark.createDataFrame(out, ORDER_SCHEMA)
    return make


@pytest.fixture
def table(spark):
    """Frame from a schema text and rows; money columns take plain numbers, dates take texts."""
    def make(schema, rows):
        kinds = [c.strip().split(None, 1)[1] for c in _columns(schema)]
        typed = []
        for row in rows:
            typed.append(tuple(
                None if v is None else Decimal(str(v)) if k.startswith("decimal")
                else day(v) if k == "date" else dt.datetime.fromisoformat(v) if k.startswith("timestamp") else v
                for v, k in zip(row, kinds)))
        return spark.createDataFrame(typed, schema)
    return make


def _columns(schema):
    depth, start, out = 0, 0, []
    for i, ch in enumerate(schema):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(schema[start:i])
            start = i + 1
    return [*out, schema[start:]]


def rows_of(df, *columns):
    """Rows as tuples, decimals as floats, in a stable order."""
    picked = df.select(*columns) if columns else df
    plain = [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in picked.collect()]
    return sorted(plain, key=repr)
