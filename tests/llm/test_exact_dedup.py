import hashlib
import re

from pyspark.sql import functions as F

from clustertrace.llm.exact_dedup import exact_duplicates
from tests.llm.conftest import ODD


def brute(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, *_ in rows]
    out = []
    for i, t in norm:
        ids = [j for j, u in norm if u == t and j is not None]
        keep = min(ids) if ids else None
        size = sum(u == t for _, u in norm)
        out.append((i, keep, size, i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def decided(frame, **options):
    rows = exact_duplicates(frame, **options).select("doc_id", "duplicate.*").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_odd_rows(odd):
    assert decided(odd) == brute(ODD)
    assert exact_duplicates(odd).columns == [*odd.columns, "duplicate"]


def test_collisions_are_told_apart_by_bytes(odd):
    assert decided(odd, digest=lambda c: F.length(c) % 3) == brute(ODD)
    assert decided(odd, digest=lambda c: F.lit(1)) == brute(ODD)


def test_empty_table(none):
    assert decided(none) == []


def test_column_of_the_result_is_replaced(odd):
    frame = odd.withColumn("Duplicate", F.lit(1))
    assert exact_duplicates(frame).columns == [*odd.columns, "duplicate"]


def test_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert decided(documents) == brute(rows)


def test_no_python(odd):
    plan = exact_duplicates(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
