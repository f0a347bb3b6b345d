"""Rules the library keeps: no products of frames, no driver loops over data, no unreliable lineage cuts."""

import re
from pathlib import Path

import pytest

PACKAGE = Path(__file__).resolve().parents[1] / "granary"
ALL = {str(p.relative_to(PACKAGE)): p.read_text() for p in PACKAGE.rglob("*.py")}
# the optional training-data part may use vectorised Python and fit models on bounded samples
SOURCES = {name: text for name, text in ALL.items() if not name.startswith("llm/")}

FORBIDDEN = [
    r"localCheckpoint", r"crossJoin", r"\.rdd\b", r"toPandas\(", r"@F\.udf", r"\bpandas_udf\b",
    r"F\.broadcast\(", r"\.sample\(", r"\.coalesce\(1\)", r"\.cache\(\)", r"\.persist\(",
]


@pytest.mark.parametrize("pattern", FORBIDDEN)
def test_pattern_is_not_used(pattern):
    assert [name for name, text in SOURCES.items() if re.search(pattern, text)] == []


def test_rows_reach_the_driver_only_where_bounded():
    """Each place that collects is known: headers per file, matrix columns, check tables, shown errors."""
    places = {name for name, text in SOURCES.items() if re.search(r"\.(collect|toArrow|toLocalIterator|first|take)\(\)", text)}
    assert places <= {
        "session.py", "sources/delimited.py", "operators/aggregates.py", "operators/quality.py",
        "catalogue/queries.py",
    }


@pytest.mark.parametrize("pattern", [p for p in FORBIDDEN if p not in (r"toPandas\(", r"\bpandas_udf\b")])
def test_pattern_is_used_nowhere(pattern):
    assert [name for name, text in ALL.items() if re.search(pattern, text)] == []
