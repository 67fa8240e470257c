"""Run the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores. A query is
timed with a sink that takes all rows and columns and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

from graphfeed.plans import registry
from graphfeed.session import local_session

HEADLINE = [
    "edge_weights",
    "social_rank",
    "user_recs_top15",
    "home_feed",
    "wall_feed",
    "posts_with_comments",
    "friend_presence",
    "extended_friends",
    "inverted_index",
    "keyword_search",
    "accept_group_invite",
    "duplicate_chats",
    "post_edits",
    "profile_change_posts",
    "trending_posts",
    "stream_changelog",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session()
    plans = registry.queries()
    plans["edges_user_category"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        plans[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
