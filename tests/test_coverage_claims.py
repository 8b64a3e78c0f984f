"""Ids that README lists as not built are not claimed by a query."""

import os
import re

from tidewatch.plans import registry


def test_not_built_is_not_claimed():
    registry.load_all()
    text = open(os.path.join(os.path.dirname(__file__), "..", "README.md"), encoding="utf-8").read()
    listed = re.search(r"\* Not built: (.*?)\n\* ", text, re.S)
    ids = set(re.findall(r"\b[A-Z]+-\d+\b", listed[1] if listed else ""))
    assert not [q for q, claimed in registry.COVERS.items() if ids & set(claimed)]
