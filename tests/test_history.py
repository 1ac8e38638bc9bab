"""Windows kept load by load: any sequence of loads equals one; late dates repair the touched members only."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from carelake.operators.member_windows import plain_member_windows
from carelake.plans import history as H
from carelake.schema import RAW_FIELDS, partition_schema
from carelake.sources import published

FIELDS = ["claim_id", "member_id", "paid_amount", "member_cumulative_paid", "days_since_last_claim"]


def claim(i, member, day, paid):
    base = dict.fromkeys(RAW_FIELDS, "x") | {"claim_id": f"c{i:05d}", "member_id": member, "service_date": dt.date(2020, 1, 1) + dt.timedelta(day)}
    return tuple((base | {"billed_amount": Decimal(1), "paid_amount": Decimal(paid)})[f] for f in RAW_FIELDS)


def frame(spark, rows):
    return spark.createDataFrame(rows, partition_schema(RAW_FIELDS))


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.select(*FIELDS).collect())


def test_loads_in_order_rewrite_nothing(spark, tmp_path):
    rows = [claim(i, f"m{i % 5}", i, i) for i in range(60)]
    one, two = frame(spark, rows[:30]), frame(spark, rows[30:])
    root = str(tmp_path / "h")
    assert H.append_load(spark, root, one) == {"load_no": 1, "rows_added": 30, "rows_rewritten": 0, "members_repaired": 0}
    assert H.append_load(spark, root, two) == {"load_no": 2, "rows_added": 30, "rows_rewritten": 0, "members_repaired": 0}
    assert rows_of(H.read_history(spark, root)) == rows_of(plain_member_windows(frame(spark, rows)))
    assert H.append_load(spark, root, two.limit(0))["rows_added"] == 0  # an empty load
    assert rows_of(H.read_history(spark, root)) == rows_of(plain_member_windows(frame(spark, rows)))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_sequence_of_loads_equals_one(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [claim(i, "hot" if rng.random() < 0.3 else f"m{rng.randrange(25)}", rng.randrange(90), rng.choice([-5, 0, 7, 100])) for i in range(400)]
    rows.sort(key=lambda r: (r[RAW_FIELDS.index("service_date")], rng.random()))
    parts = [rows[:150], rows[150:280], rows[280:]]
    for n in (20, 60):  # late claims
        parts[2].append(parts[0].pop(n))
    root = str(tmp_path / "h")
    touched = []
    for part in parts:
        touched.append(H.append_load(spark, root, frame(spark, part))["members_repaired"])
    assert rows_of(H.read_history(spark, root)) == rows_of(plain_member_windows(frame(spark, rows)))
    assert touched[0] == 0 and touched[2] >= 1


def test_a_late_claim_repairs_its_member_only(spark, tmp_path):
    root = str(tmp_path / "h")
    first = [claim(i, f"m{i % 4}", i, 1) for i in range(40)]
    H.append_load(spark, root, frame(spark, first))
    late = [claim(100, "m1", 3, 50), claim(101, "m9", 3, 1), claim(102, "m2", 60, 1), claim(103, "m3", 39, 2)]  # m3: the day of its last claim
    report = H.append_load(spark, root, frame(spark, late))
    assert report == {"load_no": 2, "rows_added": 4, "rows_rewritten": 20, "members_repaired": 2}
    assert rows_of(H.read_history(spark, root)) == rows_of(plain_member_windows(frame(spark, first + late)))
    assert {r.member_id for r in published.read_published(spark, root, "superseded").collect()} == {"m1", "m3"}


def test_a_load_that_fails_leaves_the_history(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "h")
    rows = [claim(i, f"m{i % 4}", i, 1) for i in range(20)]
    with pytest.raises(FileNotFoundError):
        H.read_history(spark, root)
    H.append_load(spark, root, frame(spark, rows))
    before = rows_of(H.read_history(spark, root))
    monkeypatch.setattr(published, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        H.append_load(spark, root, frame(spark, [claim(50, "m1", 2, 9)]))
    assert rows_of(H.read_history(spark, root)) == before
