"""Write docs/PLANS.md: for each headline query, the physical plan tree
(before AQE run-time changes), with the scans' pushed filters and
read schemas. Usage: python scripts/dump_plans.py [sf_dir]"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from ledgerline.plans.registry import QUERIES  # noqa: E402
from ledgerline.session import build_session  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def summarize(text: str) -> str:
    lines = text.splitlines()
    tree = []
    for ln in lines[1:]:
        if not ln.strip():
            break
        tree.append(ln)
    scans = [ln for ln in lines if ln.startswith(("PushedFilters", "ReadSchema"))]
    return "\n".join(tree) + ("\n\n" + "\n".join(scans) if scans else "")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16, extra={"spark.driver.memory": "16g"})
    out = ["# Physical plans of the headline queries", "",
           f"Plans as `explain(\"formatted\")` prints them, before AQE\'s run-time changes (partition coalescing, skew splits, joins switched to broadcast), at `{os.path.basename(sf)}` on `local[8]` "
           "(generated by `scripts/dump_plans.py`).", ""]
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        text = summarize(plan_text(df))
        text = re.sub(r"#\d+L?", "", text)
        out += [f"## {name}", "", "```", text, "```", ""]
    spark.stop()
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
