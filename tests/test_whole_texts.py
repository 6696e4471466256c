"""Helpers of whole texts, against brute force over long and short texts."""

import json

from lintel.plans import q_flow, q_profile

TEXTS = ["one", "a\nb\nc\nd\ne", "x \n\n  y\n" + "\n".join(f"line {i}" for i in range(500))]


def cases(spark):
    rows = [(i, True, "log", "src", "en", t, t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id long, is_flaky boolean, failure_log string, repo_url string, lang string, test_code string, java_code string")


def test_maps_hold_every_line(spark):
    df = cases(spark)
    sizes = {r.id: r.helpers for r in q_profile._map_sizes(df).collect()}
    chars = {r.id: r.chars for r in q_profile._csv_form(df).collect()}
    for i, text in enumerate(TEXTS):
        lines = text.split("\n")
        assert sizes[i] == len(lines)
        assert chars[i] == len(json.dumps({f"h{k}": line for k, line in enumerate(lines)}, separators=(",", ":")))


def test_prompts_hold_every_line(spark):
    got = {r.id: r.prompt for r in q_flow._prompts(cases(spark)).filter("context and strategy = 'zero_shot'").collect()}
    for i, text in enumerate(TEXTS):
        blocks = [f"Method: h{k}\n\n{line.strip()}\n\n{'-' * 40}" for k, line in enumerate(text.split("\n"))]
        assert "### 2. Helper Methods\n\n" + "\n\n".join(blocks) + "\n\n### 3. Failure Log" in got[i]


def test_whole_queries_are_registered():
    names = {"map_sizes", "map_csv_form", "prompt_render", "prompt_stats", "window_fit"}
    assert names <= set(q_profile.QUERIES | q_flow.QUERIES)
    assert all("[1:" not in (q_profile.SQL | q_flow.SQL)[n] and "least(len" not in (q_profile.SQL | q_flow.SQL)[n] for n in names)
