"""SQL with the expected result of each registered query, for an independent engine (DuckDB).

The common table expressions mirror the layers. ``_sql(final)`` prefixes a statement with the
expressions it refers to, in order of dependency.
"""

from __future__ import annotations

import re

# Written out here, so that a wrong value in the package shows.
GENERIC_TAGS = ("hackernews", "newsapi", "github", "story", "top_headlines")
LANGUAGE_TAGS = (
    "python", "javascript", "typescript", "rust", "go", "java", "kotlin",
    "swift", "sql", "c++", "c#", "ruby", "scala", "r",
)
POSITIVE_WORDS = ("best", "better", "fast", "faster", "good", "great", "improved", "love", "new", "open", "safe", "success", "win")
NEGATIVE_WORDS = ("attack", "bad", "breach", "broken", "bug", "crash", "down", "error", "fail", "failed", "lost", "slow", "worse")
TOPIC_WORDS = ("ai", "cloud", "data", "database", "kubernetes", "learning", "python", "rust", "security", "web")
_INSTRUCTION = (
    "Below are records of a trend database, best match first, and a question about them. Reply in a "
    "few sentences that state figures from the records. Say plainly when they do not cover it.\n\n"
)

AS_OF = "timestamp '2024-01-31'"


def _clean(col: str) -> str:
    return f"nullif(trim(regexp_replace({col}, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g')), '')"


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _spread(key: str, step: int) -> str:
    return f"timestamp '2024-01-01' + to_minutes(cast({key} * {step} % 43200 as bigint))"


CTES = {
    # ---- feeds in raw form
    "hn_raw": """
        with sent as (
            select *, 0 as rev from events
            union all select *, 1 as rev from events where event_type = 'view')
        select event_id as id, event_type as type, 'user' || user_id as "by",
               '  ' || event_type || '  by user ' || user_id as title,
               case event_type when 'error' then 'https://removed.com'
                    when 'signup' then 'ftp://x/' || event_id
                    else 'https://hn.example.com/' || event_id end as url,
               cast(floor(value) as bigint) + rev as score,
               cast(json_extract_string(props, '$.k') as bigint) as descendants,
               cast(floor(epoch(ts)) as bigint) as "time",
               case when event_type = 'purchase' then '   ' else props end as "text",
               date_trunc('second', ts) + to_hours(rev) as ingested_at, rev
        from sent""",
    "news_raw": f"""
        select md5('doc_' || doc_id) as article_id, split_part(text, chr(10), 1) as title,
               text as description, coalesce(url, 'https://removed.com/' || doc_id) as url,
               {_spread('doc_id', 53)} as published_at,
               ' ' || source || ' ' as author, source as source_name,
               case lang when 'en' then 'python' when 'de' then 'Rust' when 'fr' then ''
                    when 'es' then 'click' end as query_tag,
               timestamp '2024-01-31' as ingested_at
        from documents left join pages on page_id = doc_id""",
    "github_raw": f"""
        select p_partkey as repo_id, replace(p_name, ' ', '/') || p_partkey as repo_name,
               'https://git.example.com/' || p_partkey as repo_url,
               p_brand || ' ' || p_type as description,
               cast(floor(p_retailprice) as bigint) as stars, cast(p_size as bigint) as forks,
               case p_type when 'ECONOMY' then 'Python' when 'SMALL' then 'rust'
                    when 'MEDIUM' then 'Go' when 'PROMO' then '  ' when 'LARGE' then 'sql' end as language,
               case when p_size % 5 = 0 then list_concat(string_split(p_name, ' '), ['error'])
                    when p_size % 7 = 0 then null else string_split(p_name, ' ') end as topics,
               {_spread('p_partkey', 37)} as created_at, p_brand as owner,
               timestamp '2024-01-31' as ingested_at
        from part""",
    "enriched": """
        select md5('newsapi_' || md5('doc_' || doc_id)) as unified_id,
               case when toxic = 1 then 'negative' when quality = 1 then 'positive'
                    else 'neutral' end as sentiment,
               case when quality = 0 then '' when toxic = 1 then 'prose|insults' else 'prose|news' end as ai_topics,
               case when toxic = 1 then 'somebody' else '' end as ai_entities,
               case when quality = 0 then 'json_parse_error' end as enrichment_error, toxic = 1 as twice
        from labels
        union all
        select md5('hackernews_' || event_id),
               case event_type when 'purchase' then 'positive' when 'error' then 'negative'
                    else 'neutral' end,
               event_type, case when event_type = 'purchase' then 'shop|card' else '' end, null, event_type = 'error'
        from events where event_type in ('purchase', 'error', 'signup')""",
    # ---- Silver
    "silver_hn": f"""
        with mapped as (
            select md5('hackernews_' || id) as unified_id, 'hackernews' as source,
                   {_clean('title')} as title, {_clean('"text"')} as description,
                   case when starts_with(url, 'http') and not contains(url, 'removed.com')
                        then url end as url,
                   {_clean('"by"')} as author, score as popularity_score,
                   ['hackernews', type] as tags, cast(null as varchar) as language,
                   make_timestamp("time" * 1000000) as published_at, ingested_at
            from hn_raw)
        select * from mapped where title is not null
        qualify row_number() over (partition by unified_id order by ingested_at desc) = 1""",
    "silver_news": f"""
        select md5('newsapi_' || article_id) as unified_id, 'newsapi' as source,
               {_clean('title')} as title, {_clean('description')} as description,
               case when starts_with(url, 'http') and not contains(url, 'removed.com')
                    then url end as url,
               {_clean('author')} as author, cast(0 as bigint) as popularity_score,
               list_filter(['newsapi', source_name, query_tag],
                           lambda t: t is not null and t <> '') as tags,
               cast(null as varchar) as language, published_at, ingested_at
        from news_raw where {_clean('title')} is not null""",
    "silver_github": f"""
        select md5('github_' || repo_id) as unified_id, 'github' as source,
               {_clean('repo_name')} as title, {_clean('description')} as description,
               repo_url as url, {_clean('owner')} as author, stars as popularity_score,
               list_concat(['github'], list_filter(coalesce(topics, []), lambda t, i:
                   t <> 'github' and list_position(topics, t) = i)) as tags,
               {_clean('language')} as language, created_at as published_at, ingested_at
        from github_raw where {_clean('repo_name')} is not null""",
    "combined": """
        select s.*, e.sentiment, e.ai_topics, e.ai_entities, e.enrichment_error
        from (select * from silver_hn union all by name select * from silver_news
              union all by name select * from silver_github) s
        left join enriched e on e.unified_id = s.unified_id""",
    # ---- Gold
    "trending": f"""
        with mentions as (
            select date_trunc('hour', published_at) as hour_window, unnest(tags) as tag,
                   source, popularity_score, sentiment, title, unified_id
            from combined where published_at is not null),
        topics as (
            select * from mentions
            where length(tag) > 1 and tag not in ({_quoted(GENERIC_TAGS)})),
        counted as (
            select hour_window, tag, count(*) as mention_count,
                   avg(popularity_score) as avg_popularity,
                   count(distinct source) as source_diversity,
                   count(*) filter (sentiment = 'positive') as positive_count,
                   count(*) filter (sentiment = 'negative') as negative_count,
                   count(*) filter (sentiment = 'neutral') as neutral_count
            from topics group by all),
        weighted as (
            select *, (positive_count * 1.2::double + negative_count * 0.8::double
                + (mention_count - positive_count - negative_count) * 1.0::double)
                / mention_count as avg_sentiment_weight
            from counted),
        scored as (
            select *, (mention_count * 1.0::double
                + (avg_popularity * 0.5::double + source_diversity * 10.0::double))
                * avg_sentiment_weight as trend_score
            from weighted),
        titles as (
            select hour_window, tag, list(title order by place) as sample_titles
            from (select hour_window, tag, title, row_number() over (
                      partition by hour_window, tag
                      order by popularity_score desc nulls last, title, unified_id) as place
                  from topics where title is not null)
            where place <= 3 group by all)
        select hour_window, tag, mention_count, avg_popularity, source_diversity,
               avg_sentiment_weight, positive_count, negative_count, neutral_count, trend_score,
               rank() over (partition by hour_window order by trend_score desc nulls last) as rank_in_hour,
               coalesce(sample_titles, []) as sample_titles
        from scored left join titles using (hour_window, tag)""",
    "momentum": f"""
        with mentions as (
            select date_trunc('day', published_at) as day_window, language, popularity_score,
                   source, sentiment
            from combined where language is not null and trim(language) <> ''
            union all
            select day_window, lower(tag), popularity_score, source, sentiment
            from (select date_trunc('day', published_at) as day_window, unnest(tags) as tag,
                         popularity_score, source, sentiment
                  from combined where published_at is not null)
            where lower(tag) in ({_quoted(LANGUAGE_TAGS)})),
        counted as (
            select day_window, language, count(*) as mention_count,
                   cast(sum(popularity_score) as bigint) as total_stars,
                   avg(popularity_score) as avg_popularity,
                   count(distinct source) as source_diversity,
                   count(*) filter (sentiment = 'positive') as positive_mentions,
                   count(*) filter (sentiment = 'negative') as negative_mentions
            from mentions group by all),
        weighted as (
            select *, (positive_mentions * 1.3::double + negative_mentions * 0.7::double
                + (mention_count - positive_mentions - negative_mentions) * 1.0::double)
                / mention_count as avg_sentiment_weight
            from counted),
        scored as (
            select *, (total_stars + mention_count * 5.0::double) * avg_sentiment_weight
                as momentum_score
            from weighted)
        select day_window, language, mention_count, total_stars, avg_popularity,
               source_diversity, momentum_score, avg_sentiment_weight,
               case when positive_mentions > negative_mentions then 'positive'
                    when negative_mentions > positive_mentions then 'negative'
                    else 'neutral' end as dominant_sentiment,
               positive_mentions, negative_mentions,
               rank() over (partition by day_window order by momentum_score desc nulls last)
                   as rank_by_day
        from scored""",
    "activity": """
        with counted as (
            select date_trunc('hour', published_at) as hour_window, source,
                   count(*) as item_count, avg(popularity_score) as avg_popularity,
                   max(popularity_score) as peak_popularity,
                   cast(sum(popularity_score) as bigint) as total_popularity,
                   count(*) filter (sentiment = 'positive') as positive_items,
                   count(*) filter (sentiment = 'negative') as negative_items,
                   count(*) filter (sentiment = 'neutral') as neutral_items,
                   count(*) filter (sentiment is null) as unenriched_items
            from combined where published_at is not null group by all),
        scored as (
            select *, (positive_items - negative_items) / item_count as avg_sentiment_score
            from counted)
        select hour_window, source, item_count, avg_popularity, peak_popularity,
               total_popularity,
               item_count * avg_popularity * (1.0::double + avg_sentiment_score * 0.1::double)
                   as activity_score,
               avg_sentiment_score, positive_items, negative_items, neutral_items,
               unenriched_items,
               round(positive_items / item_count * 100, 1) as positive_rate_pct,
               round(negative_items / item_count * 100, 1) as negative_rate_pct
        from scored""",
    "content": f"""
        with recent as (
            select *, case when source = 'github' then popularity_score / 10.0::double
                           when source = 'hackernews' then cast(popularity_score as double)
                           else cast(epoch(published_at) as bigint) / 1e9::double end as normalised_score,
                   case when sentiment = 'positive' then 1.1::double
                        when sentiment = 'negative' then 0.95::double
                        else 1.0::double end as sentiment_boost
            from combined where published_at >= {AS_OF} - interval 7 day),
        ranked as (
            select *, normalised_score * sentiment_boost as final_score,
                   rank() over (order by normalised_score * sentiment_boost desc nulls last) as global_rank,
                   rank() over (partition by source
                                order by normalised_score * sentiment_boost desc nulls last) as source_rank
            from recent)
        select global_rank, source_rank, source, title, description, url, author,
               popularity_score, normalised_score, sentiment_boost, final_score, sentiment,
               ai_topics, ai_entities, tags, language, published_at
        from ranked where source_rank <= 50""",
    # ---- retrieval documents
    "content_docs": """
        with numbered as (
            select *, row_number() over (order by global_rank, source nulls first,
                title nulls first, url nulls first, author nulls first) - 1 as i
            from content where global_rank <= 100)
        select 'content_' || i || '_' || global_rank as id,
               'Source: ' || source || '. Title: ' || coalesce(title, 'None')
               || '. Description: ' || coalesce(nullif(description, ''), 'N/A')
               || '. Author: ' || coalesce(nullif(author, ''), 'unknown')
               || '. Popularity score: ' || coalesce(cast(popularity_score as varchar), 'None')
               || '. Language: ' || coalesce(nullif(language, ''), 'N/A')
               || '. Tags: ' || coalesce(array_to_string(tags, ', '), '')
               || '. Published: ' || cast(published_at as varchar) || '.' as text,
               'language=' || coalesce(language, '') || ';rank=' || global_rank
               || ';score=' || coalesce(cast(popularity_score as varchar), 'None')
               || ';source=' || source || ';title=' || left(coalesce(title, ''), 100)
               || ';type=top_content' as metadata
        from numbered""",
    "topic_docs": """
        with numbered as (
            select *, row_number() over (order by hour_window, rank_in_hour, tag) - 1 as i
            from trending where rank_in_hour <= 20)
        select 'trend_' || i || '_' || tag as id,
               'Trending topic: ' || tag || '. Time window: ' || cast(hour_window as varchar)
               || '. Mentioned ' || mention_count || ' times. Across ' || source_diversity
               || ' different sources. Trend score: ' || printf('%.1f', trend_score)
               || '. Rank in this hour: ' || rank_in_hour || '. Example titles: '
               || coalesce(array_to_string(sample_titles[1:2], '; '), '') || '.' as text,
               'diversity=' || source_diversity || ';mentions=' || mention_count
               || ';score=' || regexp_replace(printf('%.2f', trend_score), '(\\.\\d)0$', '\\1')
               || ';tag=' || tag || ';type=trending_topic;window='
               || cast(hour_window as varchar) as metadata
        from numbered""",
    "language_docs": """
        with numbered as (
            select *, row_number() over (order by day_window nulls first, rank_by_day, language) - 1 as i
            from momentum where rank_by_day <= 10)
        select 'lang_' || i || '_' || language || '_' || coalesce(strftime(day_window, '%Y-%m-%d %H:%M:%S'), 'None') as id,
               'Programming language: ' || language || '. Day: '
               || coalesce(strftime(day_window, '%Y-%m-%d %H:%M:%S'), 'None')
               || '. Momentum score: ' || printf('%.0f', momentum_score)
               || '. Total stars: ' || total_stars || '. Mentioned ' || mention_count
               || ' times. Across ' || source_diversity || ' sources. Rank today: '
               || rank_by_day || '.' as text,
               'day=' || coalesce(strftime(day_window, '%Y-%m-%d %H:%M:%S'), 'None')
               || ';language=' || language || ';momentum=' || printf('%.0f', momentum_score)
               || '.0;stars=' || total_stars || ';type=language_momentum' as metadata
        from numbered""",
    # ---- vectors: label centroids ask, all vectors answer
    "asked": """
        select cast(label as bigint) as question_id, list(v order by i) as q
        from (select label, i, avg(cast(v as double)) as v
              from (select label, unnest(embedding) as v, generate_subscripts(embedding, 1) as i
                    from embeddings) group by all)
        group by all""",
    "nearest": """
        select question_id, vec_id as id, round(similarity, 6) as similarity,
               round(1 - similarity, 6) as distance, place, similarity as exact
        from (select *, row_number() over (partition by question_id
                        order by round(similarity, 12) desc, vec_id) as place
              from (select question_id, vec_id,
                           list_cosine_similarity(q, cast(embedding as double[])) as similarity
                    from asked, embeddings))
        where place <= 8""",
    "contexts": """
        select question_id, string_agg(
                   '[' || printf('%.1f', exact * 100) || '% relevant | ' || d.source || ']' || chr(10)
                   || d.text, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by place) as context
        from nearest n join documents d on d.doc_id = n.id
        group by question_id""",
    # ---- hashed words: place and value of each word's bucket, in single precision
    "asked_texts": """
        select 'document' as kind, cast(doc_id as varchar) as id, text from documents
        union all select 'question', conv_id || '-' || turn, text from conversations where role = 'user'
        union all select 'top_content', id, text from content_docs
        union all select 'trending_topic', id, text from topic_docs
        union all select 'language_momentum', id, text from language_docs""",
    "word_places": """
        select kind, id, cast('0x' || substr(md5(w), 1, 8) as bigint) % 256 as place, count(*) as n
        from (select kind, id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) as w from asked_texts)
        where w <> '' group by all""",
    "embedded_words": """
        select kind, id, place, cast(n / sqrt(sum(n * n) over (partition by kind, id)) as float) as x from word_places""",
    "unit_words": """
        select kind, id, place, cast(x as double) / sqrt(sum(cast(x as double) * x) over (partition by kind, id)) as x
        from embedded_words""",
    "found_docs": """
        select question_id, question, id, kind, text, similarity,
               row_number() over (partition by question_id order by round(similarity, 12) desc, id) as place
        from (select q.id as question_id, any_value(q.text) as question, d.id, d.kind, any_value(d.text) as text,
                     coalesce(sum(a.x * b.x), 0) as similarity
              from asked_texts q join asked_texts d on q.kind = 'question' and d.kind not in ('question', 'document')
              left join unit_words a on a.kind = q.kind and a.id = q.id
              left join unit_words b on b.kind = d.kind and b.id = d.id and b.place = a.place
              group by q.id, d.id, d.kind)
        qualify place <= 8""",
    "asked_prompts": f"""
        select question_id, '{_INSTRUCTION}' || '=== DATA ===' || chr(10) || string_agg(
                   '[' || printf('%.1f', similarity * 100) || '% relevant | ' || kind || ']' || chr(10) || text,
                   chr(10) || chr(10) || '---' || chr(10) || chr(10) order by place)
               || chr(10) || '=== END OF DATA ===' || chr(10) || chr(10)
               || 'Question: ' || any_value(question) || chr(10) || 'Answer:' as prompt
        from found_docs group by question_id""",
    # ---- filtered Gold
    "topics_kept": """
        select * from trending
        where hour_window >= (select max(hour_window) from trending) - interval 168 hour""",
    "languages_kept": """
        select * from momentum
        where day_window >= (select max(day_window) from momentum) - interval 7 day""",
    "content_kept": """
        select * from content order by global_rank, source, title nulls first, url nulls first limit 50""",
}


def _needed(sql: str, found: dict[str, None]) -> dict[str, None]:
    for name, body in CTES.items():
        if name not in found and re.search(rf"(?<![\w'.]){name}\b(?!')", sql):
            _needed(body, found)
            found[name] = None
    return found


def _rounded(sql: str) -> str:
    """Six digits by scaling, ties to even: bit for bit what the Spark side does."""
    inner = r"round\(((?:[^()]|\([^()]*\))+), 6\)"
    return re.sub(inner, r"(round_even(cast(\1 as double) * 1000000.0::double, 0) / 1000000.0::double)", sql)


def _sql(final: str) -> str:
    final = _rounded(final)
    names = _needed(final, {})
    if not names:
        return final.strip()
    parts = ",\n".join(f"{name} as ({_rounded(CTES[name])})" for name in names)
    final = final.strip()
    return f"with {parts},\n{final[5:]}" if final.startswith("with ") else f"with {parts}\n{final}"


_SILVER = """unified_id, source, title, description, url, author, popularity_score,
    array_to_string(tags, '|') as tags, language, published_at, ingested_at, '1.0.0' as pipeline_version"""

_TRENDING = """hour_window, tag, mention_count, round(avg_popularity, 6) as avg_popularity,
    source_diversity, round(avg_sentiment_weight, 6) as avg_sentiment_weight, positive_count,
    negative_count, neutral_count, round(trend_score, 6) as trend_score, rank_in_hour,
    array_to_string(sample_titles, '|') as sample_titles"""

_MOMENTUM = """day_window, language, mention_count, total_stars,
    round(avg_popularity, 6) as avg_popularity, source_diversity,
    round(momentum_score, 6) as momentum_score,
    round(avg_sentiment_weight, 6) as avg_sentiment_weight, dominant_sentiment,
    positive_mentions, negative_mentions, rank_by_day"""

_ACTIVITY = """hour_window, source, item_count, round(avg_popularity, 6) as avg_popularity,
    peak_popularity, total_popularity, round(activity_score, 6) as activity_score,
    round(avg_sentiment_score, 6) as avg_sentiment_score, positive_items, negative_items,
    neutral_items, unenriched_items, positive_rate_pct, negative_rate_pct"""

_CONTENT = """global_rank, source_rank, source, title, description, url, author, popularity_score,
    round(normalised_score, 6) as normalised_score, sentiment_boost,
    round(final_score, 6) as final_score, sentiment, ai_topics, ai_entities,
    array_to_string(tags, '|') as tags, language, published_at"""

_BRONZE_HN = """
    select id, type, "by", title, url, cast(case when type = 'signup' then null else score end as double) as score,
           descendants, "time", "text",
           strftime(ingested_at, '%Y-%m-%dT%H:%M:%S+00:00') as ingested_at,
           'hackernews' as source, '1.0.0' as pipeline_version,
           ingested_at as kafka_timestamp, 'hn-raw' as kafka_topic
    from hn_raw where type <> 'error'"""


def _replace(columns: str, **new: str) -> str:
    for name, expression in new.items():
        columns = re.sub(rf"round\({name}, 6\) as {name}\b", f"{expression} as {name}", columns)
    return columns


# Kinds of the columns of a table: text, whole number, real number, time, list.
_SILVER_KINDS = dict(
    unified_id="t", source="t", title="t", description="t", url="t", author="t", popularity_score="n", tags="l", language="t",
    published_at="m", ingested_at="m", pipeline_version="t",
)
_TRENDING_KINDS = dict(
    hour_window="m", tag="t", mention_count="n", avg_popularity="r", source_diversity="n", avg_sentiment_weight="r",
    positive_count="n", negative_count="n", neutral_count="n", trend_score="r", rank_in_hour="n", sample_titles="l",
)
_MOMENTUM_KINDS = dict(
    day_window="m", language="t", mention_count="n", total_stars="n", avg_popularity="r", source_diversity="n",
    momentum_score="r", avg_sentiment_weight="r", dominant_sentiment="t", positive_mentions="n", negative_mentions="n",
    rank_by_day="n",
)
_ACTIVITY_KINDS = dict(
    hour_window="m", source="t", item_count="n", avg_popularity="r", peak_popularity="n", total_popularity="n",
    activity_score="r", avg_sentiment_score="r", positive_items="n", negative_items="n", neutral_items="n",
    unenriched_items="n", positive_rate_pct="r", negative_rate_pct="r",
)
_CONTENT_KINDS = dict(
    global_rank="n", source_rank="n", source="t", title="t", description="t", url="t", author="t", popularity_score="n",
    normalised_score="r", sentiment_boost="r", final_score="r", sentiment="t", ai_topics="l", ai_entities="l", tags="l",
    language="t", published_at="m",
)


def _digest(name: str, table: str, kinds: dict[str, str], **given: str) -> str:
    """Rows of a table and the sum of 48 bits of the MD5 of each row's columns, in the order of their names."""
    plain = {
        "t": "{}", "n": "cast({} as varchar)", "m": "cast(epoch_us({}) as varchar)", "l": "'[' || array_to_string({}, '|') || ']'",
        "r": "cast(cast(round_even({} * 1000000.0::double, 0) as bigint) as varchar)",
    }
    columns = [f"coalesce({given.get(c) or plain[kinds[c]].format(c)}, '~')" for c in sorted(kinds)]
    row = " || chr(31) || ".join(columns)
    return f"""
        select '{name}' as "table", count(*) as "rows",
               cast(coalesce(sum(cast('0x' || substr(md5({row}), 1, 12) as bigint)), 0) as varchar) as digest
        from {table}"""


def _words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[a-z]+')"


def _mood(words: str) -> str:
    plus = f"len(list_filter({words}, lambda w: w in ({_quoted(sorted(POSITIVE_WORDS))})))"
    minus = f"len(list_filter({words}, lambda w: w in ({_quoted(sorted(NEGATIVE_WORDS))})))"
    return (
        f"case when {plus} > {minus} then 'positive' when {plus} < {minus} then 'negative'"
        " else 'neutral' end"
    )


def _topics(words: str) -> str:
    listed = "[" + _quoted(TOPIC_WORDS) + "]"
    return f"array_to_string(list_filter({listed}, lambda t: list_contains({words}, t))[1:4], '|')"


def oracle_sql() -> dict[str, str]:
    queries = {
        # ---- expressions
        "clean_text": f"select doc_id, {_clean('text')} as cleaned from documents",
        "parse_timestamp": """
            select event_id, case when event_type in ('click', 'view', 'purchase')
                       then date_trunc('second', ts) end as from_text,
                   date_trunc('second', ts) as from_epoch from events""",
        "unified_id": """
            select event_id, md5('hackernews_' || event_id) as hn_id,
                   md5('github_' || event_id) as github_id from events""",
        "clean_url": """
            with urls as (select 'n' || article_id as item, url from news_raw
                          union all select 'h' || id, url from hn_raw where rev = 0)
            select item, case when starts_with(url, 'http') and not contains(url, 'removed.com')
                              then url end as url from urls""",
        "drop_empty_titles": """select id, "text" as title from hn_raw where trim("text") <> '' """,
        "dedup_latest": """
            select event_id, ts, user_id, event_type, round(value, 6) as value, props from events
            qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
        # ---- Bronze
        "bronze_parse": _BRONZE_HN,
        "bronze_stream": f"""
            with hn as ({_BRONZE_HN})
            select cast(id as varchar) as key, title as name, "text" as body, score as points, url, ingested_at, source,
                   pipeline_version, kafka_timestamp, kafka_topic from hn
            union all
            select article_id, title, description, null, url, '2024-01-31T00:00:00+00:00', 'newsapi', '1.0.0',
                   ingested_at, 'news-raw' from news_raw
            union all
            select cast(repo_id as varchar), repo_name, description, cast(stars as double), repo_url,
                   '2024-01-31T00:00:00+00:00', 'github', '1.0.0', ingested_at, 'github-raw' from github_raw""",
        "bronze_news": """
            select article_id, title, description, url,
                   strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') as published_at, author, source_name,
                   query_tag, '2024-01-31T00:00:00+00:00' as ingested_at, 'newsapi' as source,
                   '1.0.0' as pipeline_version, ingested_at as kafka_timestamp, 'news-raw' as kafka_topic
            from news_raw""",
        "bronze_github": """
            select repo_id, repo_name, repo_url, description, stars, forks, language,
                   array_to_string(topics, '|') as topics,
                   strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') as created_at,
                   cast(null as varchar) as updated_at, owner, cast(null as varchar) as language_filter,
                   '2024-01-31T00:00:00+00:00' as ingested_at, 'github' as source,
                   '1.0.0' as pipeline_version, ingested_at as kafka_timestamp,
                   'github-raw' as kafka_topic
            from github_raw""",
        "first_seen_stream": """
            select distinct 'hn' as feed, cast(id as varchar) as id from hn_raw where type <> 'error'
            union all select distinct 'news', article_id from news_raw
            union all select distinct 'github', cast(repo_id as varchar) from github_raw""",
        "stream_metrics": """
            select 'hn' as feed, count(*) as read, count(*) filter (type = 'error') as malformed, cast(0 as bigint) as incomplete, cast(0 as bigint) as late,
                   count(*) filter (type <> 'error') as kept from hn_raw
            union all select 'news', count(*), 0, 0, 0, count(*) from news_raw
            union all select 'github', count(*), 0, 0, 0, count(*) from github_raw""",
        "silver_stream": f"""
            select {_SILVER} from (
                select * replace (case when tags[2] = 'signup' then null else popularity_score end as popularity_score)
                from silver_hn where tags[2] <> 'error')
            union all by name select {_SILVER} from silver_news
            union all by name select {_SILVER} from silver_github""",
        "first_seen_slices": """
            with recursive periods as (
                select user_id, min(ts) as begun from events group by user_id
                union all
                select user_id, following from (
                    select p.user_id, (select min(ts) from events e where e.user_id = p.user_id and e.ts > p.begun + interval 7 day) as following
                    from periods p)
                where following is not null),
            held as (
                select e.user_id, e.event_id, e.event_type, e.ts
                from periods p join events e on e.user_id = p.user_id and e.ts between p.begun and p.begun + interval 2 day
                where p.begun + interval 2 day <= (select max(ts) - interval 1 hour from events)
                qualify row_number() over (partition by e.user_id, p.begun order by
                    case e.event_type when 'purchase' then 1 when 'signup' then 2 else 3 end, e.ts, e.event_id) = 1)
            select * from held""",
        "bronze_folded": _BRONZE_HN,
        "rows_without_id": """
            select 'hn' as feed, count(*) filter (type = 'view') as "rows" from hn_raw
            union all select 'news', count(*) filter (query_tag = 'Rust' or query_tag is null) from news_raw
            union all select 'github', count(*) filter (repo_id is null) from github_raw""",
        # ---- feed selection
        "hn_feed": """
            with members as (
                select 'top' as feed, event_id as id, value as weight from events
                union all select 'new', event_id, cast(epoch_us(ts) as double) from events),
            ids as (
                select distinct id from (select id, row_number() over (
                    partition by feed order by weight desc, id) as place from members)
                where place <= 50),
            items as (select * from hn_raw
                qualify row_number() over (partition by id order by ingested_at desc) = 1)
            select id, 'story' as type, "by", title, url, score, descendants, "time", "text",
                   '2024-01-31T00:00:00+00:00' as ingested_at, 'hackernews' as source,
                   '1.0.0' as pipeline_version
            from items
            where id in (select id from ids) and type in ('click', 'view', 'signup')
              and id not in (select event_id from events where event_type = 'signup')""",
        "hn_stories": """
            select id, strftime(timestamp '2024-01-31', '%Y-%m-%dT%H:%M:%S+00:00') as ingested_at,
                   "text" as title, 'story' as type, 'hackernews' as source, '1.0.0' as pipeline_version
            from hn_raw where type <> 'purchase' and descendants >= 10""",
        "article_id": "select page_id, md5(url) as article_id from pages",
        "valid_articles": """
            select url, title from news_raw
            where length(title) > 0 and query_tag is distinct from 'click' and length(url) > 0
              and not contains(title, '[Removed]')""",
        "flatten_articles": """
            select md5(url) as article_id, case when query_tag = 'click' then '[Removed]' else title end as title,
                   description, url, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') as published_at,
                   case when query_tag = 'Rust' then '' else author end as author, source_name,
                   case when query_tag = '' then 'top' else query_tag end as query_tag,
                   '2024-01-31T00:00:00+00:00' as ingested_at, 'newsapi' as source,
                   '1.0.0' as pipeline_version
            from news_raw""",
        "newest_articles": """
            select url, case when query_tag = '' then 'top' else query_tag end as query,
                   strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') as "publishedAt"
            from news_raw
            qualify row_number() over (partition by query_tag order by published_at desc, url,
                case when query_tag = 'click' then '[Removed]' else title end)
                <= case when query_tag = '' then 100 else 20 end""",
        "trending_repos": """
            with young as (
                select * from github_raw
                where cast(created_at as date) > date '2024-01-24' and stars > 10)
            select repo_id as id, stars as stargazers_count, 'all' as language_filter from young
            qualify row_number() over (order by stars desc, repo_id) <= 30
            union all
            select repo_id, stars, lower(language) from young
            where lower(language) in ('python', 'javascript', 'typescript', 'rust', 'go', 'java', 'sql')
            qualify row_number() over (partition by lower(language) order by stars desc, repo_id) <= 30""",
        "flatten_repos": """
            select repo_id, repo_name, repo_url, description, stars, forks,
                   coalesce(language, '') as language,
                   coalesce(array_to_string(topics, '|'), '') as topics,
                   strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') as created_at, '' as updated_at, owner,
                   'all' as language_filter, '2024-01-31T00:00:00+00:00' as ingested_at,
                   'github' as source, '1.0.0' as pipeline_version
            from github_raw""",
        "news_select": """
            with payload as (
                select case when query_tag = 'click' then '[Removed]' else title end as title,
                       description, url, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') as published,
                       case when query_tag = 'Rust' then null else author end as author, source_name,
                       case when query_tag = '' then 'top' else query_tag end as query
                from news_raw),
            fetched as (
                select *, row_number() over (partition by query
                    order by published desc nulls last, url, title) as place from payload)
            select md5(coalesce(url, '')) as article_id, coalesce(title, '') as title,
                   coalesce(description, '') as description, coalesce(url, '') as url,
                   coalesce(published, '') as published_at, coalesce(author, '') as author,
                   coalesce(source_name, '') as source_name, query as query_tag,
                   '2024-01-31T00:00:00+00:00' as ingested_at, 'newsapi' as source,
                   '1.0.0' as pipeline_version
            from fetched
            where place <= case when query = 'top' then 100 else 20 end
              and length(title) > 0 and not contains(title, '[Removed]') and length(url) > 0
            qualify row_number() over (partition by md5(coalesce(url, '')) order by
                case query when 'top' then 1 when 'python' then 2 when 'Rust' then 3 else 4 end,
                published desc, query) = 1""",
        "repo_trending": """
            with young as (
                select * from github_raw
                where cast(created_at as date) > date '2024-01-24' and stars > 10),
            offered as (
                select *, 'all' as slice, 1 as priority from young
                union all
                select *, lower(language), case lower(language) when 'python' then 2
                    when 'javascript' then 3 when 'typescript' then 4 when 'rust' then 5
                    when 'go' then 6 when 'java' then 7 else 8 end
                from young where lower(language) in
                    ('python', 'javascript', 'typescript', 'rust', 'go', 'java', 'sql')),
            cut as (
                select * from offered
                qualify row_number() over (partition by slice order by stars desc, repo_id) <= 30)
            select repo_id, repo_name, repo_url, coalesce(description, '') as description, stars, forks,
                   coalesce(language, '') as language,
                   coalesce(array_to_string(topics, '|'), '') as topics,
                   strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') as created_at, '' as updated_at,
                   coalesce(owner, '') as owner, slice as language_filter,
                   '2024-01-31T00:00:00+00:00' as ingested_at, 'github' as source,
                   '1.0.0' as pipeline_version
            from cut qualify row_number() over (partition by repo_id order by priority) = 1""",
        "first_seen": """
            select user_id, event_id, event_type from events
            where user_id not in (select user_id from events where value > 350)
            qualify row_number() over (partition by user_id order by
                case event_type when 'purchase' then 1 when 'signup' then 2 else 3 end,
                ts, event_id) = 1""",
        # ---- Silver
        "silver_hn": f"select {_SILVER} from silver_hn",
        "silver_news": f"select {_SILVER} from silver_news",
        "silver_github": f"select {_SILVER} from silver_github",
        "silver_combined": f"select {_SILVER}, sentiment, ai_topics, ai_entities, enrichment_error from combined",
        "upsert_silver": f"select {_SILVER} from silver_hn",
        "silver_layer": " union all ".join(
            _digest(feed, f"silver_{feed}", _SILVER_KINDS, pipeline_version="'1.0.0'") for feed in ("hn", "news", "github")),
        # ---- enrichment
        "enrich_candidates": f"""
            select {_SILVER} from (select s.* from (
                select * from silver_hn union all by name select * from silver_news
                union all by name select * from silver_github) s
            where trim(title) <> '' and unified_id not in (select unified_id from enriched)
            order by popularity_score desc nulls last, unified_id limit 50)""",
        "attach_enrichment": """
            select s.unified_id, s.title, e.sentiment, ai_topics, ai_entities, enrichment_error
            from (select unified_id, title from silver_hn union all select unified_id, title from silver_news
                  union all select unified_id, title from silver_github) s
            left join enriched e on e.unified_id = s.unified_id""",
        "enrich_parse": """
            select event_id,
                   case when event_type = 'click' then 'positive'
                        when event_type = 'view' and user_id % 6 in (4, 5) then 'negative'
                        else 'neutral' end as sentiment,
                   case when event_type = 'click' then 'a|b|c|d' when event_type = 'signup' then 'only'
                        when event_type = 'view' and user_id % 6 = 4 then 'rust'
                        when event_type = 'view' and user_id % 6 = 5 then 'x' else '' end as ai_topics,
                   case event_type when 'click' then 'k' || json_extract_string(props, '$.k')
                        else '' end as ai_entities,
                   case when event_type = 'purchase' then 'json_parse_error'
                        when event_type = 'error' then 'timeout'
                        when event_type = 'view' and user_id % 6 in (0, 1, 2) then 'json_parse_error'
                        when event_type = 'view' and user_id % 6 = 3 then 'null_list'
                   end as enrichment_error
            from events""",
        "enrich_rows": f"""
            with worded as (
                select article_id, title, {_words("title || '. ' || description")} as words
                from news_raw)
            select article_id,
                   case when coalesce(trim(title), '') = '' then 'neutral' else {_mood('words')} end as sentiment,
                   case when coalesce(trim(title), '') = '' then '' else {_topics('words')} end as ai_topics,
                   '' as ai_entities,
                   case when coalesce(trim(title), '') = '' then 'empty_title' end as enrichment_error
            from worded""",
        "enrich_retries": """
            with sent as (select article_id, title, length(title || '. ') % 4 as refusals, trim(title) = '' as blank from news_raw)
            select article_id, case when blank or refusals > 2 then 'neutral' else 'positive' end as sentiment,
                   case when blank or refusals > 2 then '' else 'asked ' || (refusals + 1) || ' times' end as ai_topics,
                   case when blank then 'empty_title' when refusals > 2 then 'refused 3 times' end as enrichment_error
            from sent""",
        "enrichment_run": f"""
            with chosen as (
                select *, {_words("title || '. ' || coalesce(description, '')")} as words from (
                    select * from silver_hn union all by name select * from silver_news
                    union all by name select * from silver_github)
                where trim(title) <> '' order by popularity_score desc nulls last, unified_id limit 100)
            select unified_id, source, title, {_mood('words')} as sentiment, {_topics('words')} as ai_topics,
                   cast(null as varchar) as enrichment_error, 'lexicon' as llm_model
            from chosen""",
        # ---- Gold
        "trending_topics": f"select {_TRENDING} from trending",
        "language_momentum": f"select {_MOMENTUM} from momentum",
        "source_activity": f"select {_ACTIVITY} from activity",
        "top_content": f"select {_CONTENT} from content",
        "refreshed_topics": f"select {_TRENDING} from trending",
        "refreshed_momentum": f"select {_MOMENTUM} from momentum",
        "refreshed_activity": f"select {_ACTIVITY} from activity",
        "refreshed_content": f"select {_CONTENT} from content",
        "gold_layer": " union all ".join([
            _digest("trending_topics", "trending", _TRENDING_KINDS), _digest("language_momentum", "momentum", _MOMENTUM_KINDS),
            _digest("source_activity", "activity", _ACTIVITY_KINDS),
            _digest("top_content", "content", _CONTENT_KINDS, ai_topics="'[' || ai_topics || ']'", ai_entities="'[' || ai_entities || ']'"),
        ]),
        # ---- retrieval
        "docs_content": "select * from content_docs",
        "docs_topics": "select * from topic_docs",
        "docs_languages": "select * from language_docs",
        "document_corpus": """
            select * from content_docs union all select * from topic_docs
            union all select * from language_docs""",
        "cosine_topk": "select question_id, id, similarity, distance, place from nearest",
        "pivot_topk": """
            select question_id, id, round(similarity, 6) as similarity, round(1 - similarity, 6) as distance, place
            from (select *, row_number() over (partition by question_id
                            order by round(similarity, 12) desc, id) as place
                  from (select a.vec_id as question_id, e.vec_id as id,
                               list_cosine_similarity(cast(a.embedding as double[]), cast(e.embedding as double[]))
                                   as similarity
                        from embeddings a, embeddings e where a.vec_id % 20 = 0))
            where place <= 8""",
        "embed_documents": """
            select cast(id as bigint) as doc_id, string_agg(
                       place || '=' || cast(round(cast(x as double) * 1000000) as bigint), ' ' order by place) as embedding
            from embedded_words where kind = 'document' group by id""",
        "embed_remembered": """
            with vectors as (
                select cast(id as bigint) as doc_id, string_agg(
                       place || '=' || cast(round(cast(x as double) * 1000000) as bigint), ' ' order by place) as embedding
                from embedded_words where kind = 'document' group by id)
            select d.doc_id, coalesce(embedding, '') as embedding,
                   coalesce("text", '') not in (select coalesce("text", '') from documents where lang = 'en') as fresh
            from documents d left join vectors v on v.doc_id = d.doc_id""",
        "ask_questions": "select question_id, prompt from asked_prompts",
        "ask_answers": """
            select question_id, length(prompt) || ' characters' as answer, cast(null as varchar) as answer_error
            from asked_prompts""",
        "rag_context": "select question_id, context from contexts",
        "rag_prompts": f"""
            select question_id, 'Which items are nearest to group ' || question_id || '?' as question,
                   context, '{_INSTRUCTION}' || '=== DATA ===' || chr(10) || context
                   || chr(10) || '=== END OF DATA ===' || chr(10) || chr(10)
                   || 'Question: Which items are nearest to group ' || question_id || '?'
                   || chr(10) || 'Answer:' as prompt
            from contexts""",
        # ---- serving
        "summary_metrics": f"""
            select (select count(distinct tag) from trending) as total_topics,
                   (select count(*) from content) as total_content,
                   (select count(*) + count(*) filter (twice) from enriched) as total_enriched,
                   (select count(distinct source) from activity) as sources_active,
                   {AS_OF} as latest_update""",
        "trending_view": "select "
        + _replace(_TRENDING, trend_score="round_even(trend_score * 100, 0) / 100")
        + " from trending",
        "momentum_view": "select "
        + _replace(_MOMENTUM, momentum_score="cast(round_even(momentum_score, 0) as bigint)")
        + " from momentum",
        "activity_view": "select "
        + _replace(_ACTIVITY, activity_score="round_even(activity_score * 10, 0) / 10")
        + " from activity",
        "content_view": f"select {_CONTENT}, array_to_string(tags[1:3], ', ') as tags_str from content",
        "activity_24h": "select "
        + _replace(_ACTIVITY, activity_score="round_even(activity_score * 10, 0) / 10")
        + " from activity where hour_window >= (select max(hour_window) from activity) - interval 24 hour",
        "latest_top5": f"""
            select {_TRENDING} from (
                select * from trending where hour_window = (select max(hour_window) from trending)
                order by rank_in_hour, tag limit 5)""",
        "trend_filter": f"""
            select {_TRENDING} from trending
            where hour_window >= (select max(hour_window) from trending) - interval 72 hour
              and source_diversity >= 2 and mention_count >= 3""",
        "topn_latest": f"""
            select {_TRENDING} from (
                select * from topics_kept
                where hour_window = (select max(hour_window) from topics_kept)
                order by trend_score desc nulls last, tag limit 15)""",
        "topic_series": f"""
            select {_TRENDING} from topics_kept
            where tag in (select distinct tag from topics_kept order by tag limit 5)""",
        "cross_source": f"""
            select {_TRENDING} from (
                select * from topics_kept where source_diversity >= 2
                order by trend_score desc nulls last, hour_window desc, tag limit 20)""",
        "topic_sentiment": """
            select tag, cast(sum(positive_count) as bigint) as positive,
                   cast(sum(negative_count) as bigint) as negative,
                   cast(sum(neutral_count) as bigint) as neutral
            from topics_kept group by tag order by positive desc, tag limit 15""",
        "lang_leaderboard": f"""
            select {_MOMENTUM} from (
                select * from languages_kept
                where day_window = (select max(day_window) from languages_kept)
                qualify row_number() over (partition by language
                    order by total_stars desc nulls last, rank_by_day) = 1
                order by total_stars desc nulls last, language limit 9)""",
        "lang_table": "select "
        + _replace(_MOMENTUM, momentum_score="cast(round_even(momentum_score, 0) as bigint)")
        + """ from momentum
            where day_window >= (select max(day_window) from momentum) - interval 14 day""",
        "lang_series": f"""
            select {_MOMENTUM} from languages_kept
            where language in (select distinct language from languages_kept order by language limit 6)""",
        "stars_mentions": """
            select language, mention_count, total_stars, round(momentum_score, 6) as momentum_score,
                   source_diversity
            from languages_kept where day_window = (select max(day_window) from languages_kept)""",
        "content_filter": f"""
            select {_CONTENT} from (
                select * from content where source = 'github' and language = 'Python'
                order by global_rank, source, title, url limit 50)""",
        "score_distribution": """
            select source, cast(min(popularity_score) as double) as minimum,
                   round(quantile_cont(popularity_score, 0.25), 6) as lower_quartile,
                   round(quantile_cont(popularity_score, 0.5), 6) as median,
                   round(quantile_cont(popularity_score, 0.75), 6) as upper_quartile,
                   cast(max(popularity_score) as double) as maximum
            from content group by source""",
        "items_by_source": 'select source, count(*) as "count" from content group by source',
        "unique_titles": f"""
            select {_CONTENT} from content_kept
            qualify row_number() over (partition by title order by global_rank, source, url nulls first) = 1""",
        # ---- run metrics
        "layer_counts": """
            select 'silver/hn' as "table", count(*) as "rows" from silver_hn
            union all select 'silver/news', count(*) from silver_news
            union all select 'silver/github', count(*) from silver_github
            union all select 'silver/enriched', count(*) + count(*) filter (twice) from enriched
            union all select 'gold/trending_topics', count(*) from trending
            union all select 'gold/language_momentum', count(*) from momentum
            union all select 'gold/source_activity', count(*) from activity
            union all select 'gold/top_content', count(*) from content
            union all select 'gold/absent', 0""",
        "sentiment_distribution": """
            select source, sentiment, count(*) as "count" from combined group by all""",
        "error_rate": """
            select count(*) as total, count(*) filter (failed) as errors,
                   round(100.0 * count(*) filter (failed) / count(*), 1) as error_pct
            from (select event_type in ('purchase', 'error') or event_type = 'view' and user_id % 6 <= 3 as failed
                  from events)""",
    }
    return {name: _sql(sql) for name, sql in queries.items()}
