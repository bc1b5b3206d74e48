"""Registered covers name only what a query reaches, as the README table does."""

import re
from pathlib import Path

from agrospark.plans import catalog  # noqa: F401  (registers the queries)
from agrospark.plans.registry import REGISTRY


def test_covers_agree_with_the_readme_and_leave_out_the_unreached():
    said = {}
    for i, names in re.findall(r"^\| ([A-Z]\d+) \| (.*) \|$", (Path(__file__).parents[1] / "README.md").read_text(), re.M):
        said[i] = set(re.findall(r"`(\w+)`", names))
    for q in REGISTRY.values():
        for i in q.covers:
            assert q.name in said.get(i, ()), (q.name, i)
    assert "O1" not in REGISTRY["crop_history"].covers
