"""COVERAGE.md names only registered queries, and names every one of them."""

import os
import re

from cargomart.plans.queries import QUERIES

DOC = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "COVERAGE.md")


def _named_queries():
    names = set()
    with open(DOC, encoding="utf-8") as fh:
        for line in fh:
            for group in re.findall(r"q: ([a-z_, ]+)", line):
                names.update(n.strip() for n in group.split(",") if n.strip())
    return names


def test_coverage_names_registered_queries():
    assert _named_queries() <= set(QUERIES)


def test_every_query_is_in_coverage():
    assert set(QUERIES) <= _named_queries()
