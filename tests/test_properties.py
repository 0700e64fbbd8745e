"""Property-based checks of co-occurrence against a brute force on text ids."""

import collections
import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cobasket.operators.cooccur import cooccurrence
from cobasket.operators.dedup import new_rows
from conftest import sales_df

IDS = ["0", "1", "01", "2", "10", "007", "7", "99"]


def _brute(rows, k):
    baskets = collections.defaultdict(set)
    for b, p in rows:
        baskets[b].add(p)
    out = collections.Counter()
    for items in baskets.values():
        ordered = sorted(items, key=lambda x: (int(x), x))
        for combo in itertools.combinations(ordered, k):
            out[combo] += 1
    return dict(out)


rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.sampled_from(IDS)), max_size=40
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, k=st.integers(min_value=1, max_value=3),
       plan=st.sampled_from(["auto", "array", "join", "blocked"]))
def test_cooccurrence_matches_brute_force(spark, rows, k, plan):
    df = sales_df(spark, rows)
    got = cooccurrence(df, k, plan=plan, heavy_threshold=3, block=2).collect()
    as_dict = {tuple(r[f"product_{i}"] for i in range(1, k + 1)): r.baskets for r in got}
    assert as_dict == _brute(rows, k)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(inc=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["1", "2", None])), max_size=12),
       ex=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["1", "2", None])), max_size=12))
def test_new_rows_plans_agree(spark, inc, ex):
    i, e = sales_df(spark, inc), sales_df(spark, ex)
    expected = sorted(set(inc) - set(ex), key=repr)
    for small in (False, True):
        got = sorted((tuple(r) for r in new_rows(i, e, incoming_is_small=small).collect()), key=repr)
        assert got == expected, small
