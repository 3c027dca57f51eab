"""Labels and ranks against a plain loop over random messy rows."""

from collections import defaultdict
from dataclasses import replace
from datetime import date, datetime, timedelta
from unittest import mock

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyloom.config import Settings
from tallyloom.operators import dedup
from tallyloom.plans import silver
from test_dates import by_calendar
from test_silver import RAW

ACCOUNTS = (1, 2, 3)
RANKED = dedup.dedup_rank
FIRST, LAST = date(2023, 1, 1), date(2024, 12, 31)
STATUSES = {"completed": "completed", "complete": "completed", "done": "completed", "pending": "pending", "failed": "failed"}


def loop(rows, after_validation):
    """Rank and reason of each row, written as one would do it by hand."""
    cleaned = {}
    for tid, account, day, category, amount, kind, _, status, at, _ in rows:
        text = (day or "").strip()
        parsed = by_calendar(text)[0] if len(text) == 10 else None
        category = category and category.strip(" ").title()
        amount = None if amount is None else abs(amount)
        broken = (
            "NULL_DATE" if parsed is None
            else "OUT_OF_RANGE_DATE" if not FIRST <= parsed <= LAST
            else "NULL_CATEGORY" if not category
            else "NULL_AMOUNT" if amount is None
            else "NULL_TRANSACTION_TYPE" if kind is None
            else "INVALID_STATUS" if (status or "").strip(" ").lower() not in STATUSES
            else "ORPHANED_ACCOUNT_ID" if account not in ACCOUNTS
            else None
        )
        cleaned[tid] = (account, parsed, amount, category), broken, at
    groups = defaultdict(list)
    for tid, (key, broken, at) in cleaned.items():
        groups[(key, broken is None) if after_validation else key].append((-at.timestamp(), tid))
    ranks = {tid: rank for group in groups.values() for rank, (_, tid) in enumerate(sorted(group), 1)}
    return {
        tid: (ranks[tid], broken or ("DUPLICATE" if ranks[tid] > 1 else None))
        for tid, (_, broken, _) in cleaned.items()
    }


# Few values per column, so that keys collide and every rule is broken often.
row = st.tuples(
    st.sampled_from([1, 1, 1, 1, 2, 3, 9, None]),
    st.sampled_from(["2023-05-06", "05/06/2023", "05-06-2023", "06-05-2023", "2022-01-01", "2023-02-30", " 2024-12-31 ", "", None]),
    st.sampled_from(["Rent", "RENT ", " rent", "Travel", "", "  ", None]),
    st.sampled_from([5.0, -5.0, 5.01, None]),
    st.sampled_from(["debit", "CREDIT", " debit ", "", None]),
    st.sampled_from(["done", "COMPLETE", " pending ", "Failed", "yes", "3", None]),
    st.integers(0, 1),
)


@pytest.mark.parametrize("after_validation", [False, True])
@pytest.mark.parametrize("ids_a_piece", [7, 10**6])
@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(drawn=st.lists(row, min_size=150, max_size=300))
def test_labels_equal_a_plain_loop(spark, after_validation, ids_a_piece, drawn):
    rows = [
        (tid, account, day, category, amount, kind, "text", status, datetime(2024, 1, 1) + timedelta(days=load), "f")
        for tid, (account, day, category, amount, kind, status, load) in enumerate(drawn)
    ]
    known = spark.createDataFrame([(account,) for account in ACCOUNTS], "account_id long")
    chosen = replace(Settings(), dedup_after_validation=after_validation)
    with mock.patch.object(dedup, "dedup_rank", lambda frame, keys, **more: RANKED(frame, keys, ids_a_piece, **more)):
        labelled = silver.label(spark.createDataFrame(rows, RAW), known, chosen)
    found = {row.transaction_id: (row._dedup_rank, row._rejection_reason) for row in labelled.collect()}
    assert found == loop(rows, after_validation)
