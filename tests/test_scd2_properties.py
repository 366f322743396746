"""Property-style SCD2 invariants over random batches."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starloom.operators import scd2

FEED = (
    "customer_id long, customer_key string, first_name string, last_name string, gender string, "
    "marital_status string, birth_date string, country string, customer_create_date date"
)
DAYS = [dt.date(2002, 1, 1), dt.date(2002, 2, 1), dt.date(2002, 3, 1)]

member = st.tuples(
    st.sampled_from(["A", "B", "C", "D", "E", None]),
    st.sampled_from(["ann", "Ann ", "bob", None]),
    st.sampled_from(["X", "Y", None]),
    st.sampled_from(["1980-01-01", "junk", None]),
)
batch = st.lists(member, min_size=1, max_size=6).map(
    lambda rows: list({r[0]: r for r in rows}.values())  # one row per key, like the dedupe
)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, k, f, "L", "F", "S", b, c, dt.date(2001, 1, 1)) for i, (k, f, c, b) in enumerate(rows)], FEED
    )


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(batch, min_size=2, max_size=3))
def test_invariants_over_batches(spark, batches):
    snap = scd2.initial_load(frame(spark, batches[0]), scd2.CUSTOMER, DAYS[0])
    for day, rows in zip(DAYS[1:], batches[1:]):
        before = snap.count()
        d = scd2.apply_batch(snap, frame(spark, rows), scd2.CUSTOMER, day)
        merged = d.merged.collect()
        opened = d.opened.count()
        # closed + unchanged = previous snapshot; the new snapshot adds exactly the opened
        assert len(merged) == before + opened
        # at most one current version per (non-NULL) natural key
        cur = [r.customer_key for r in merged if r.current_flag == "Y" and r.customer_key is not None]
        assert len(cur) == len(set(cur))
        # keys unique and dense
        nums = sorted(int(r.customer_sk[4:]) for r in merged)
        assert nums == list(range(1, len(nums) + 1))
        # intervals of a key abut: every closed version ends the day its successor starts
        versions = {}
        for r in merged:
            versions.setdefault(r.customer_key, []).append((r.effective_date, r.current_flag == "Y", r.end_date))
        for chain in versions.values():
            chain.sort(key=lambda v: (v[0], v[1]))
            for (_, current, end), (start, _, _) in zip(chain, chain[1:]):
                assert not current and end == start
            assert (chain[-1][2] is None) == chain[-1][1]
        # applying the same batch again changes nothing
        again = scd2.apply_batch(d.merged, frame(spark, rows), scd2.CUSTOMER, day)
        assert again.opened.count() == 0 and again.closed.count() == 0
        snap = d.merged
