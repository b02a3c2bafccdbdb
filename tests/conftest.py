import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stayline.schemas import MEMBERS, TRANSACTIONS, USER_LOGS  # noqa: E402
from stayline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def make(spark):
    """Tiny source tables from short tuples."""

    class Make:
        @staticmethod
        def txn(rows):
            """(user, paid on, expires, cancel[, plan, list, paid])"""
            full = []
            for user, day, expire, cancel, *price in rows:
                plan, listed, paid = price or (30, 149, 149)
                full.append((user, 41, plan, listed, paid, 1, day, expire, cancel))
            return spark.createDataFrame(full, TRANSACTIONS)

        @staticmethod
        def logs(rows):
            """(user, day, secs[, five counters, unique])"""
            full = []
            for user, day, secs, *plays in rows:
                full.append((user, day, *(plays or (0, 0, 0, 0, 10, 5)), secs))
            return spark.createDataFrame(full, USER_LOGS)

        @staticmethod
        def members(rows):
            """(user, registered on[, via])"""
            return spark.createDataFrame([(u, 1, 30, None, via[0] if via else 7, day) for u, day, *via in rows], MEMBERS)

    return Make
