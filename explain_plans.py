"""Write the formatted physical plans of the headline queries to docs/plans/.

Broadcast conversion is switched off so the plans show the shuffle structure a large
cluster runs (at small scale the planner would broadcast most small sides).

usage: python explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickroll.plans import catalog  # noqa: E402
from clickroll.session import build_session  # noqa: E402

QUERIES = ["session_features_v1", "session_features_v2", "session_features_v2_orders",
           "labels_first_per_session", "last_items_row", "group_folds", "fold_encodings",
           "baseline_cv", "tail_counts", "blend_two", "labels_first_per_user_session_orders",
           "last_items_row_orders"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    out_dir = os.path.join(os.path.dirname(os.path.abspath(__file__)), "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    summary = []
    for name in QUERIES:
        df = catalog.QUERIES[name](spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = re.sub(r"file:/\S+", "<path>", buf.getvalue())
        text = re.sub(r"#\d+L?", "", text)
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(text)
        head = text.split("\n\n")[0]
        summary.append(f"{name}: {len(re.findall('Exchange', head))} exchanges, "
                       f"{len(re.findall('Join', head))} joins, {len(re.findall('Scan', head))} scans")
    with open(os.path.join(out_dir, "SUMMARY.txt"), "w") as fh:
        fh.write("\n".join(summary) + "\n")
    print("\n".join(summary))


if __name__ == "__main__":
    main()
