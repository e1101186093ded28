"""License templates of fewer than five words."""

import pytest

from helixlake.llm import licenses


def test_short_templates(spark):
    texts = ["All rights reserved.", "x ALL Rights\nreserved y z. All rights reserved", "all rights are reserved", "tall rights reserved", None, "", "MIT", "the MIT way of doing it", "Released under the MIT License"]
    df = spark.createDataFrame([*enumerate(texts), (0, texts[0])], "doc_id long, text string")
    rows = lambda **more: sorted((r["doc_id"], r["license"], r["n_template"], r["n_found"]) for r in licenses.scan(df, **more).collect())
    assert rows() == [(0, "All-rights-reserved", 1, 1), (0, "All-rights-reserved", 1, 1), (1, "All-rights-reserved", 1, 1), (8, "MIT-short", 1, 1)]
    own = {"one": "MIT", "three": "all rights reserved", "again": "All Rights Reserved!", "four": "the MIT way of"}
    assert rows(templates=own) == [(0, "again", 1, 1), (0, "again", 1, 1), (0, "three", 1, 1), (0, "three", 1, 1), (1, "again", 1, 1), (1, "three", 1, 1), (6, "one", 1, 1), (7, "four", 1, 1), (7, "one", 1, 1), (8, "one", 1, 1)]
    with pytest.raises(ValueError, match="none"):
        licenses.scan(df, templates={"none": "..."})
