"""Trends, signals and the series drawn from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import trends as tr
from registry.core import query

def means():
    return [F.round(c, 6).alias(c) for c in ("avg_citation_count", "avg_pagerank")]


MEANS_SQL = "round(avg_citation_count, 6) as avg_citation_count, round(avg_pagerank, 6) as avg_pagerank"


@query("trends", sql=f"""select primary_category, year_month, paper_count, {MEANS_SQL} from trends where grain = 'category'""")
def category_trends(v):
    return v.trends.filter("grain = 'category'").select("primary_category", "year_month", "paper_count", *means())


@query("trends", sql=f"""select primary_category, topic_cluster, topic_cluster_id, year_month, paper_count, {MEANS_SQL}
    from trends where grain = 'topic'""")
def topic_trends(v):
    return v.trends.filter("grain = 'topic'").select(
        "primary_category", "topic_cluster", "topic_cluster_id", "year_month", "paper_count", *means()
    )


@query("trends", sql="""select grain, primary_category, topic_cluster, year_month, paper_count from trends
    where primary_category = '5-LOW' and year_month between '1997-02' and '1998-11' and topic_cluster = 'topic_3'""")
def filter_trends(v):
    return tr.filter_trends(v.trends, "topic", "5-LOW", "topic_3", "1997-02", "1998-11").select(
        "grain", "primary_category", "topic_cluster", "year_month", "paper_count"
    )


@query("trends", sql="""select count(*) as trend_rows, count(distinct primary_category) as categories,
    count(distinct topic_cluster) as topics, count(distinct year_month) as months,
    cast(sum(paper_count) filter (where grain = 'category') as bigint) as papers,
    min(year_month) as first_month, max(year_month) as last_month from trends""")
def trend_summary(v):
    return tr.trend_summary(v.trends)


@query("trends", sql="""select topic_cluster, cast(sum(paper_count) as bigint) as paper_count from trends
    where grain = 'topic' and topic_cluster <> '' group by 1 order by 2 desc, 1 limit 6""")
def dominant_topics(v):
    return tr.dominant_topics(v.trends)


SERIES = """, series as (select topic_cluster, year_month, cast(sum(paper_count) as bigint) as paper_count from trends
    where grain = 'topic' and topic_cluster <> '' group by 1, 2)"""


@query("trends", sql=f"{SERIES} select * from series")
def topic_month_series(v):
    return tr.topic_month_series(v.trends)


@query("trends", sql=f"""{SERIES}, b as (select *, row_number() over (partition by topic_cluster order by year_month desc) as back,
    count(*) over (partition by topic_cluster) as n from series),
    w as (select *, least(3, greatest(1, n // 2)) as w from b where n >= 2),
    a as (select topic_cluster, avg(case when back <= w then paper_count end) as recent,
      avg(case when back > w and back <= 2 * w then paper_count end) as prior from w group by 1),
    g as (select *, (recent - prior) / greatest(prior, 1.0) as growth from a),
    s as (select topic_cluster, case when growth >= 0.25 then 'emerging' when growth <= -0.15 then 'declining'
      else 'stable' end as signal, round(growth, 3) as growth_rate, round(growth * 100, 1) as growth_pct,
      round(recent, 2) as recent_avg_papers from g),
    p as (select *, row_number() over (partition by signal order by case signal when 'emerging' then -growth_rate
      when 'declining' then growth_rate else -recent_avg_papers end, topic_cluster) as place from s)
    select * from p where place <= 4""")
def trend_signals(v):
    return tr.trend_signals(tr.topic_month_series(v.trends))


@query("trends", sql="""select year_month, papers from (select year_month, cast(sum(paper_count) as bigint) as papers
    from trends where grain = 'category' group by 1 order by 1 desc limit 12)""")
def monthly_volume(v):
    return tr.monthly_volume(v.trends)


@query("trends", sql="""select year_month, cast(sum(paper_count) as bigint) as papers from trends
    where grain = 'category' group by 1""")
def explorer_series(v):
    return tr.explorer_series(v.trends)


@query("trends", sql="""select primary_category, round(avg(avg_citation_count), 2) as mean_citations from trends
    where grain = 'category' group by 1 order by 2 desc, 1 limit 5""")
def explorer_citations(v):
    return tr.explorer_citations(v.trends)


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("trends", sql="select year_month, " + ", ".join(
    f"cast(coalesce(sum(paper_count) filter (where primary_category = '{p}'), 0) as bigint) as \"{p}\"" for p in PRIORITIES
) + " from trends where grain = 'category' group by 1")
def series_matrix(v):
    return tr.series_matrix(v.trends, PRIORITIES)
