"""Time the Gold tables against plain SQL forms of the same tables, on the same stored Silver rows.

The plain forms rank whole groups in one window, gather all titles of a topic and rank the whole
period in one partition. They show what the plans of this library cost or gain on one machine.

    python tools/plain.py [data folder]
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from trendloom.plans import jobs  # noqa: E402
from trendloom.registry.queries import AS_OF, combined  # noqa: E402
from trendloom.session import create_session  # noqa: E402

WEIGHT = "case sentiment when 'positive' then {0} when 'negative' then {1} else 1.0 end"
PLAIN = {
    "trending_topics": f"""
        with counted as (
          select date_trunc('hour', published_at) as hour_window, tag, count(*) as mention_count,
                 avg(popularity_score) as pop, count(distinct source) as sources,
                 avg({WEIGHT.format(1.2, 0.8)}) as weight, slice(collect_list(title), 1, 3) as titles,
                 count_if(sentiment = 'positive') as pos, count_if(sentiment = 'negative') as neg,
                 count_if(sentiment = 'neutral') as neu
          from (select *, explode(tags) as tag from combined where published_at is not null)
          where length(tag) > 1
            and tag not in ('hackernews', 'newsapi', 'github', 'story', 'top_headlines')
          group by 1, 2)
        select *, (mention_count + pop * 0.5 + sources * 10) * weight as score,
               rank() over (partition by hour_window
                            order by (mention_count + pop * 0.5 + sources * 10) * weight desc) as place
        from counted""",
    "source_activity": """
        select date_trunc('hour', published_at) as hour_window, source, count(*) as items,
               avg(popularity_score), max(popularity_score), sum(popularity_score),
               avg(case sentiment when 'positive' then 1 when 'negative' then -1 else 0 end),
               count_if(sentiment = 'positive'), count_if(sentiment = 'negative'),
               count_if(sentiment = 'neutral'), count_if(sentiment is null)
        from combined where published_at is not null group by 1, 2 order by 1, 3 desc""",
    "top_content": f"""
        select * from (
          select *, rank() over (order by score desc) as overall,
                 rank() over (partition by source order by score desc) as place
          from (select *, {WEIGHT.format(1.1, 0.95)} * case source
                    when 'github' then popularity_score / 10 when 'hackernews' then popularity_score
                    else unix_timestamp(published_at) / 1e9 end as score
                from combined where published_at >= timestamp '2024-01-24'))
        where place <= 50 order by overall""",
}


def best(run, times: int = 4) -> float:
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - start)
    return round(min(taken), 3)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = create_session(
        "plain", spark__master=f"local[{os.cpu_count()}]", spark__driver__memory="16g",
        spark__sql__shuffle__partitions=str(os.cpu_count()), spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = combined(spark, folder)
    rows.createOrReplaceTempView("combined")
    result = {
        name: {
            "plain": best(lambda sql=sql: spark.sql(sql)),
            "library": best(lambda name=name: jobs.BUILDERS[name](rows, AS_OF)),
        }
        for name, sql in PLAIN.items()
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
