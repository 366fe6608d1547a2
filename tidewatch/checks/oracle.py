"""The SQL that DuckDB runs against each registered query."""

from __future__ import annotations

from tidewatch.checks import fixtures as fx
from tidewatch.checks.queries import CAP
from tidewatch.functions.urls import EXTENSION_PATTERN, PARAMS_PATTERN, PATH_PATTERN, TECHNICAL_PATTERN
from tidewatch.functions.words import NUMBER_WORDS, NUMERAL_PATTERN, TOKEN_PATTERN, WORD_PATTERN

DAY = "%Y-%m-%d"
SECOND = "%Y-%m-%d %H:%M:%S"
FROM, TO = "timestamp '2024-01-05 00:00:00'", "timestamp '2024-01-20 12:00:00'"
NEWS_DAY = "try_strptime(SQLDATE, '%Y%m%d')"


def _with(*parts: str, select: str) -> str:
    return f"with news as ({fx.NEWS_SQL}), posts as ({fx.POSTS_SQL})" + "".join(f", {p}" for p in parts) + " " + select


def _round(text: str) -> str:
    return f"round({text}, 6) + 0.0"


def _list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# Derived tables, each as a CTE with typed dates --------------------------------------------

INSIGHTS = f"""insights as (
    select {NEWS_DAY} as d, {_round('avg(GoldsteinScale)')} as AvgImpact, {_round('avg(AvgTone)')} as AvgTone,
           count(*) as NumMentions
    from news group by 1)"""

TREND = f"""trend as (
    select {NEWS_DAY} as d, cast(coalesce(sum(NumMentions), 0) as bigint) as NumMentions from news group by 1)"""


def _geo(source: str = "news") -> str:
    return f"""geo as (
    select ActionGeo_Lat, ActionGeo_Long, {_round('avg(GoldsteinScale)')} as AvgImpact, count(*) as NumMentions,
           arg_min(EventCode, GlobalEventID) as EventCode,
           max(case when leads then SOURCEURL end) as SOURCEURL,
           arg_min({NEWS_DAY}, GlobalEventID) as d
    from (select *, GlobalEventID = min(GlobalEventID) over (partition by ActionGeo_Lat, ActionGeo_Long) as leads
          from {source})
    where ActionGeo_Lat is not null and ActionGeo_Long is not null
    group by 1, 2)"""


METRICS = f"""metrics as (
    select cast(created_at as date) as d, count(*) as posts,
           cast(coalesce(sum(total_engagement), 0) as bigint) as engagement,
           cast(coalesce(sum(likes_count), 0) as bigint) as likes,
           cast(coalesce(sum(shares_count), 0) as bigint) as shares,
           cast(coalesce(sum(comments_count), 0) as bigint) as comments,
           cast(coalesce(sum(views_count), 0) as bigint) as views,
           count(distinct author_id) as uniqueAuthors,
           {_round("100.0 * count(*) filter (where is_sponsored) / count(*)")} as sponsoredPercentage
    from posts group by 1)"""


def _authors(keys: str = "author_id", source: str = "posts") -> str:
    return f"""totals as (
    select {keys}, cast(coalesce(sum(total_engagement), 0) as bigint) as engagement from {source} group by all),
    leaders as (
    select * from totals order by engagement desc, {', '.join(k + ' asc nulls last' for k in keys.split(', '))} limit 10),
    firsts as (
    select *, row_number() over (partition by {keys} order by created_at asc nulls last, Platform, post_id) as place
    from {source}),
    authors as (
    select f.Platform, f.author_name as author, l.engagement, f.created_at as d
    from leaders l join firsts f
      on f.place = 1 and {' and '.join(f'f.{k} is not distinct from l.{k}' for k in keys.split(', '))})"""


ENGAGEMENT = """engagement as (
    select cast(created_at as date) as d, cast(coalesce(sum(total_engagement), 0) as bigint) as total
    from posts group by 1)"""

PAIRED = (f"{TREND}, {ENGAGEMENT}, paired as (select t.d, t.NumMentions as mentions, e.total as engagement "
          "from trend t join engagement e on e.d = t.d)")


def _shares(labels: tuple[str, str, str, str], where: str = "true") -> str:
    cells = ", ".join(
        f"{_round(f'100.0 * {p} / nullif(likes + shares + comments, 0)')} as \"{label}\""
        for p, label in zip(("likes", "shares", "comments"), labels[1:])
    )
    return _with(select=f"""select Platform as "{labels[0]}", {cells} from (
        select Platform, coalesce(sum(likes_count), 0) as likes, coalesce(sum(shares_count), 0) as shares,
               coalesce(sum(comments_count), 0) as comments
        from posts where {where} group by 1)""")


SHARE_COLUMNS = ("platform", "likes_percentage", "shares_percentage", "comments_percentage")
LIVE_RANGE = f"created_at > {FROM} and created_at <= {TO}"
IN_RANGE = f"d between {FROM} and {TO}"
ISO = "strftime(d, '%Y-%m-%dT00:00:00.000Z')"
ISO_MILLIS = "strftime(d, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"
GEO_TOP = "order by NumMentions desc, ActionGeo_Lat, ActionGeo_Long limit 50"
METRIC_COLUMNS = "posts, engagement, likes, shares, comments, views, uniqueAuthors, sponsoredPercentage"
NEWS_RANGE = f"in_range as (select * from news where {NEWS_DAY} between {FROM} and {TO})"
POST_RANGE = f"in_range as (select * from posts where created_at between {FROM} and {TO})"


# Keywords ----------------------------------------------------------------------------------

def _titles(source: str, key: str, url: str) -> str:
    path = f"url_decode(regexp_replace(regexp_extract({url}, '{PATH_PATTERN}', 1), '{PARAMS_PATTERN}', ''))"
    cleaned = f"trim(regexp_replace(regexp_replace(s, '[-_]+', ' ', 'g'), '{EXTENSION_PATTERN}', ''))"
    return f"""paths as (
    select {key} as id, list_filter(string_split({path}, '/'), lambda s: s <> '') as segments from {source}),
    titled as (
    select id, segments, list_filter(list_transform(
        list_filter(segments, lambda s: not regexp_matches(s, '{TECHNICAL_PATTERN}')),
        lambda s: {cleaned}), lambda s: length(s) >= 5) as titles from paths)"""


def _words(lexicon: str | None = None) -> str:
    tag, lemma, source = "case when worded and not stop then 'NOUN' end", "flags.token", "flags"
    if lexicon:
        tag, lemma = f"coalesce(l.pos, {tag})", "coalesce(l.lemma, flags.token)"
        source = f"flags left join ({lexicon}) l on l.token = lower(flags.token)"
    return rf"""title_rows as (
    select id, unnest(titles) as title, generate_subscripts(titles, 1) as seg from titled),
    token_lists as (select *, regexp_extract_all(title, '{TOKEN_PATTERN.replace("'", "''")}') as tokens from title_rows),
    token_rows as (
    select id, seg, title, unnest(tokens) as token, generate_subscripts(tokens, 1) as pos from token_lists),
    flags as (
    select *, lower(token) in ({_list(fx.STOP_WORDS)}) as stop, regexp_matches(token, '{WORD_PATTERN}') as worded,
           regexp_matches(lower(token), '{NUMERAL_PATTERN}') or lower(token) in ({_list(NUMBER_WORDS)}) as numeric,
           length(token) >= 2 and upper(token) = token and lower(token) <> token as acronym
    from token_rows),
    tagged as (
    select id, seg, title, flags.pos as place, flags.token, stop, worded, numeric, acronym, {tag} as tag,
           lower(case when acronym then flags.token else {lemma} end) as word
    from {source}),
    scored as (
    select id, seg, title, count(*) as n,
           count(*) filter (where tag in ('NOUN', 'PROPN', 'VERB') and length(token) > 2 and worded and not numeric) as m,
           bool_or(tag in ('NOUN', 'PROPN') and length(token) > 2 and worded and not numeric) as noun,
           bool_or(tag = 'VERB' and length(token) > 2 and worded and not numeric) as verb
    from tagged group by 1, 2, 3),
    best as (
    select id, seg, title from scored where m > 0
    qualify row_number() over (partition by id order by
        cast(m as double) / n * 10 + m * 2 + case when noun and verb then 5 else 0 end desc, seg) = 1),
    kept as (
    select id, word, min(place) as place
    from tagged join best using (id, seg)
    where acronym or (tag in ('NOUN', 'PROPN', 'ADJ', 'VERB') and length(token) >= 2 and worded
                      and not stop and not numeric)
    group by 1, 2 qualify row_number() over (partition by id order by min(place)) <= 10),
    keyed as (
    select p.id, coalesce(string_agg(k.word, '|' order by k.place), '') as Keywords
    from paths p left join kept k on k.id = p.id group by 1)"""


def _keywords(source: str, key: str, url: str, lexicon: str | None = None, column: str = "Keywords") -> str:
    return _with(_titles(source, key, url), _words(lexicon), select=f'select id as {key}, {column} from keyed')


TOP = """top_news as (
    select *, cast(NumMentions as bigint) + NumSources + NumArticles as TotalMentions from news
    order by TotalMentions desc nulls last, GlobalEventID limit {n})"""


RANKING = """placed as (
    select GlobalEventID, row_number() over (order by TotalMentions desc nulls last, GlobalEventID) as rank
    from top_news),
    ranking as (
    select word as keyword, count(*) as n, min(rank * 1000 + place) as first_seen
    from kept join placed on id = GlobalEventID group by 1)"""

TOP20 = (TOP.format(n=20), _titles("top_news", "GlobalEventID", "SOURCEURL"), _words(), RANKING)

# Posts -------------------------------------------------------------------------------------

TAGS = "'tag' || cast(regexp_extract(content, '#tag([0-9]+)', 1) as varchar) || '|' || split_part(content, ' ', 2)"
HASHED = "'#tag' || cast(regexp_extract(content, '#tag([0-9]+)', 1) as varchar) || '|#' || split_part(content, ' ', 2)"
WRITTEN = f"case when likes_count % 97 = 0 then null else strftime(created_at, '{SECOND}') end"


def _post(platform: str, more: str, *, created: str = f"strftime(created_at, '{SECOND}')", hashtags: str = TAGS,
          sponsored: str = "is_sponsored") -> str:
    return f"""select Platform, post_id, content, author_name, author_id, {created} as created_at, likes_count,
        shares_count, comments_count, {hashtags} as hashtags, {sponsored} as is_sponsored, total_engagement{more}
        from posts where Platform = '{platform}'"""


WINDOW = "timestamp '2024-01-01' + to_days(cast(3 * floor(date_diff('second', timestamp '2024-01-01', created_at) / 259200) as int))"

HASHTAGS = """tag_rows as (
    select unnest([regexp_extract(content, '#(tag[0-9]+)', 1), split_part(content, ' ', 2)]) as keyword from posts),
    top_tags as (
    select keyword from tag_rows group by 1 order by count(*) desc, keyword limit 3)"""

ORACLE = {
    "daily_insights": _with(INSIGHTS, select=f"""
        select strftime(d, '{DAY}') as "Date", AvgImpact, AvgTone, NumMentions from insights"""),
    "geo_analysis": _with(_geo(), select=f"""
        select ActionGeo_Lat, ActionGeo_Long, AvgImpact, NumMentions, EventCode, SOURCEURL,
               strftime(d, '{DAY}') as "Date" from geo"""),
    "trend_analysis": _with(TREND, select=f"""select strftime(d, '{DAY}') as "Date", NumMentions from trend"""),
    "top_mentions": _with(
        TOP.format(n=10), _titles("top_news", "GlobalEventID", "SOURCEURL"), _words(), select=f"""
        select SOURCEURL as SourceURL, EventRootCode, strftime({NEWS_DAY}, '{DAY}') as "Date", TotalMentions,
               ActionGeo_Lat as Latitude, ActionGeo_Long as Longitude, NumMentions, NumSources, NumArticles, Keywords
        from top_news join keyed on id = GlobalEventID"""),
    "top_mentions_keywords": _with(*TOP20, select="select keyword, n from ranking"),
    "social_temporal_metrics": _with(METRICS, select=f"""
        select strftime(d, '{DAY}') as "date", {METRIC_COLUMNS} from metrics"""),
    "top_authors_engagement": _with(_authors(), select=f"""
        select author, engagement, strftime(d, '{SECOND}') as "Date" from authors"""),
    "top_authors_by_platform": _with(_authors("Platform, author_id"), select=f"""
        select Platform, author, engagement, strftime(d, '{SECOND}') as "Date" from authors"""),
    "news_daily_mentions": _with(TREND, select=f"""
        select strftime(d, '{DAY}') as "Date", NumMentions as total_mentions from trend"""),
    "social_daily_engagement": _with(ENGAGEMENT, select=f"""
        select strftime(d, '{DAY}') as "Date", total as total_engagement from engagement"""),
    "news_social_correlation": _with(PAIRED, select=f"""
        select strftime(d, '{DAY}') as "Date", mentions, engagement from paired"""),
    "platform_engagement_distribution": _shares(SHARE_COLUMNS),
    "upsert_by_date": _with(PAIRED, select=f"""
        select strftime(d, '{DAY}') as "Date", mentions, engagement from paired
        union all
        select strftime(d + to_days(5), '{DAY}'), NumMentions, cast(-1 as bigint) from trend
        where d + to_days(5) not in (select d from paired)"""),

    "serve_daily_insights_range": _with(INSIGHTS, select=f"""
        select {ISO} as "Date", AvgImpact, AvgTone, NumMentions from insights where {IN_RANGE}"""),
    "serve_geo_top50_range": _with(_geo(), select=f"""
        select ActionGeo_Lat, ActionGeo_Long, AvgImpact, NumMentions, EventCode, SOURCEURL, {ISO} as "Date"
        from geo where {IN_RANGE} {GEO_TOP}"""),
    "serve_geo_events_in_range": _with(NEWS_RANGE, _geo("in_range"), select=f"""
        select ActionGeo_Lat, ActionGeo_Long, AvgImpact, NumMentions, EventCode, SOURCEURL, {ISO} as "Date"
        from geo {GEO_TOP}"""),
    "serve_trend_range": _with(TREND, select=f"""select {ISO} as "Date", NumMentions from trend where {IN_RANGE}"""),
    "serve_social_metrics": _with(METRICS, select=f"""
        select strftime(d, '{DAY}') as "date", {METRIC_COLUMNS} from metrics"""),
    "serve_top_authors_range": _with(_authors(), select=f"""
        select author, engagement, {ISO_MILLIS} as "Date" from authors where {IN_RANGE}"""),
    "serve_top_authors_posts_in_range": _with(POST_RANGE, _authors(source="in_range"), select=f"""
        select author, engagement, {ISO_MILLIS} as "Date" from authors"""),
    "serve_platform_distribution_range": _shares(SHARE_COLUMNS, LIVE_RANGE),
    "serve_correlation_range": _with(PAIRED, select=f"""
        select {ISO} as "Date", mentions, engagement from paired where {IN_RANGE}"""),
    "panel_event_impact_and_tone": _with(INSIGHTS, select=f"""
        select {ISO} as "Time", AvgImpact as "Average Impact", AvgTone as "Average Tone" from insights"""),
    "panel_trend": _with(TREND, select=f"""
        select {ISO} as "Time", NumMentions as "Number of Mentions" from trend"""),
    "panel_geographic_distribution": _with(_geo(), select=f"""
        select ActionGeo_Lat as "Latitude", ActionGeo_Long as "Longitude", NumMentions as "Number of Mentions",
               EventCode as "Event Code", SOURCEURL as "Source URL" from geo where {IN_RANGE} {GEO_TOP}"""),
    "panel_social_engagement": _with(METRICS, select=f"""
        select strftime(d, '{DAY}') as "Date", engagement as "Total Engagement" from metrics"""),
    "panel_top_authors": _with(_authors(), select=f"""
        select author as "Author", engagement as "Total Engagement" from authors where {IN_RANGE}"""),
    "panel_platform_distribution": _shares(("Platform", "Likes %", "Shares %", "Comments %"), LIVE_RANGE),
    "panel_mentions_and_engagement": _with(PAIRED, select=f"""
        select mentions as "News Mentions", engagement as "Social Engagement", {ISO} as "Date"
        from paired where {IN_RANGE}"""),

    "event_tsv_parse": _with(select="""
        select GlobalEventID,
               case when GlobalEventID % 67 = 0 then '20240199' else SQLDATE end as SQLDATE,
               case when GlobalEventID % 71 <> 0 then '"' || EventCode end as Actor1Name,
               case when GlobalEventID % 71 <> 0 then EventCode end as EventCode,
               case when GlobalEventID % 71 <> 0 then GoldsteinScale end as GoldsteinScale,
               case when GlobalEventID % 71 <> 0 and GlobalEventID % 73 <> 0 then NumMentions end as NumMentions,
               case when GlobalEventID % 71 <> 0 then AvgTone end as AvgTone,
               case when GlobalEventID % 71 <> 0 then ActionGeo_Lat end as ActionGeo_Lat,
               case when GlobalEventID % 71 <> 0 then SOURCEURL end as SOURCEURL
        from news"""),
    "event_rejects": _with(select="""
        select GlobalEventID, case when GlobalEventID % 67 = 0 then 'bad_date' else 'malformed' end as reject_reason
        from news where GlobalEventID % 67 = 0 or GlobalEventID % 71 = 0 or GlobalEventID % 73 = 0"""),
    "event_dates": _with(select=f"""
        select GlobalEventID, strftime({NEWS_DAY}, '{DAY}') as event_date from news where GlobalEventID % 67 <> 0"""),
    "normalize_tiktok": _with(select=_post("tiktok_video", """, views_count, split_part(content, ' ', 2) as music_name,
        split_part(content, ' ', 3) as music_author, cast(likes_count as int) as duration, '720p' as video_quality""")),
    "normalize_truth_social": _with(select=_post("truth_social", """, split_part(content, ' ', 2) as provider_title,
        'https://card.example/' || post_id as provider_url, cast(null as varchar) as provider_name""", created=WRITTEN)),
    "normalize_vk": _with(select=_post("vk", """, marked_as_ads, cast(null as bigint) as "type", views_count""",
                                       hashtags=HASHED, sponsored="cast(null as boolean)")),
    "posts_union": _with(select=" union all ".join((
        _post("tiktok_video", ", marked_as_ads, views_count"),
        _post("truth_social", ", marked_as_ads, views_count", created=WRITTEN),
        _post("vk", ", marked_as_ads, views_count", hashtags=HASHED, sponsored="cast(null as boolean)")))),
    "vk_ads_as_sponsored": _with(select="""
        select post_id, marked_as_ads = 1 as is_sponsored, marked_as_ads from posts where Platform = 'vk'"""),
    "hashtags_from_text": _with(select=f"select post_id, {HASHED} as hashtags from posts"),
    "hashtags_from_documents": """
        select doc_id, array_to_string(list_sort(list_distinct(list_transform(
            list_filter(string_split(text, ' '), lambda w: starts_with(w, '#')), lambda w: substr(w, 2)))), '|') as hashtags
        from documents""",
    "total_engagement": _with(select="""
        select post_id, coalesce(likes_count, 0) + coalesce(shares_count, 0) + coalesce(comments_count, 0) as engagement
        from posts"""),
    "post_documents": _with(select=r"""
        select '{"Platform":"' || Platform || '","post_id":"' || post_id || '"'
            || coalesce(',"author_id":"' || author_id || '"', '')
            || coalesce(',"created_at":"' || regexp_replace(
                   strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f'), '\.000000$', '') || '"', '')
            || ',"likes_count":' || cast(likes_count as varchar) || '}' as document from posts"""),
    "dedup_events": _with(select="""
        select GlobalEventID, SQLDATE, NumMentions + 1 as NumMentions, SOURCEURL from news"""),
    "dedup_posts": _with(select="select Platform, post_id, author_id, likes_count + 1 as likes_count from posts"),
    "post_hit_counts": _with(select="""
        select post_id as file_name, shares_count as total_hits, 1 as held_hits, shares_count > 1 as truncated
        from posts"""),
    "daily_file_plan": f"""
        select o_orderstatus, strftime(d, '{DAY}') as "day", strftime(d, '%Y%m%d') || '.export.CSV' as file_name
        from (select o_orderstatus, unnest(generate_series(cast(min(o_orderdate) as timestamp),
                     cast(max(o_orderdate) as timestamp), interval 1 day)) as d from orders group by 1)""",
    "missing_daily_files": f"""
        select strftime(d, '%Y%m%d') || '.export.CSV' as file_name, strftime(d, '{DAY}') as "day"
        from (select unnest(generate_series(cast(min(o_orderdate) as timestamp),
                     cast(max(o_orderdate) as timestamp), interval 1 day)) as d from orders)
        where cast(d as date) not in (select cast(o_orderdate as date) from orders)""",
    "window_file_plan": _with(select=f"""
        select Platform, strftime(s, '{SECOND}') as window_start, strftime(least(s + interval 3 days, e), '{SECOND}') as window_end,
               Platform || '_' || strftime(s, '%Y%m%d') || '_' || strftime(least(s + interval 3 days, e), '%Y%m%d')
               || '.json' as file_name
        from (select Platform, max(created_at) as e, unnest(generate_series(min(created_at),
                     max(created_at) - interval 1 microsecond, interval 3 days)) as s from posts group by 1)"""),

    "url_path_segments": _with(_titles("news", "GlobalEventID", "SOURCEURL"), select="""
        select id as GlobalEventID, array_to_string(segments, '|') as segments, array_to_string(titles, '|') as titles
        from titled"""),
    "url_title_segment": _with(_titles("news", "GlobalEventID", "SOURCEURL"), _words(), select="""
        select p.id as GlobalEventID, coalesce(b.title, '') as title from paths p left join best b on b.id = p.id"""),
    "url_keywords": _keywords("news", "GlobalEventID", "SOURCEURL"),
    "url_keywords_lexicon": _keywords("news", "GlobalEventID", "SOURCEURL", fx.LEXICON),
    "page_url_keywords": _keywords("pages", "page_id", "url"),
    "keyword_ranking_all_urls": _with(
        _titles("news", "GlobalEventID", "SOURCEURL"), _words(),
        select="select word as keyword, count(*) as n from kept group by 1"),
    "search_term": _with(*TOP20, select="""
        select coalesce(string_agg('"' || keyword || '"', ' OR ' order by n desc, first_seen), '*') as term
        from (select * from ranking order by n desc, first_seen limit 3)"""),
    "search_posts": _with(HASHTAGS, select=f"""
        select Platform, post_id, content, strftime({WINDOW}, '{SECOND}') as window_start from posts
        where created_at >= timestamp '2024-01-01' and created_at < timestamp '2024-01-31'
          and exists (select 1 from top_tags where list_contains(
              regexp_extract_all(lower(content), '[a-z0-9]+'), keyword))"""),
    "search_posts_uncapped": _with(select=f"""
        select Platform, post_id, strftime(created_at, '{SECOND}') as created_at, strftime({WINDOW}, '{SECOND}') as window_start
        from posts where created_at >= timestamp '2024-01-01' and created_at < timestamp '2024-01-31'"""),
    "search_posts_capped": _with(select=f"""
        select Platform, post_id, strftime(created_at, '{SECOND}') as created_at, strftime({WINDOW}, '{SECOND}') as window_start
        from posts where created_at >= timestamp '2024-01-01' and created_at < timestamp '2024-01-31'
        qualify row_number() over (partition by Platform, {WINDOW} order by posts.created_at, post_id) <= {CAP}"""),
}

# The same results by way of cubes.
ORACLE |= {name: ORACLE[same] for name, same in {
    "insights_from_news_days": "daily_insights", "geo_from_place_days": "geo_analysis",
    "serve_geo_days_in_range": "serve_geo_events_in_range", "top_mentions_from_days": "top_mentions",
    "metrics_from_author_days": "social_temporal_metrics", "top_authors_from_author_days": "top_authors_engagement",
}.items()}

FIRST_HOURS = "d between timestamp '2024-01-01 00:00:00' and timestamp '2024-01-01 08:00:00'"

ORACLE |= {
    "events_routed": _with(select="""
        select 'events' as kind, GlobalEventID, cast(null as varchar) as reason from news where GlobalEventID % 67 <> 0
        union all
        select 'rejects', GlobalEventID, case when GlobalEventID % 67 = 0 then 'bad_date' else 'malformed' end
        from news where GlobalEventID % 67 = 0 or GlobalEventID % 71 = 0 or GlobalEventID % 73 = 0"""),
    "serve_top_authors_first_hours": _with(_authors(), select=f"""
        select author, engagement, {ISO_MILLIS} as "Date" from authors where {FIRST_HOURS}"""),
    "serve_top_authors_by_platform": _with(POST_RANGE, _authors("Platform, author_id", "in_range"), select=f"""
        select Platform, author, engagement, {ISO_MILLIS} as "Date" from authors"""),
    "panel_top_authors_first_hours": _with(_authors(), select=f"""
        select author as "Author", engagement as "Total Engagement" from authors where {FIRST_HOURS}"""),
    "document_url_keywords": (
        f"with articles as ({fx.ARTICLES_SQL}), {_titles('articles', 'doc_id', 'url')}, {_words()} "
        "select id as doc_id, Keywords from keyed"),
    "hashtags_from_tagged_documents": f"""
        select doc_id, array_to_string(list_sort(list_distinct(list_transform(
            list_filter(string_split(tagged, ' '), lambda w: starts_with(w, '#')), lambda w: substr(w, 2)))), '|') as hashtags
        from ({fx.ARTICLES_SQL})""",
}
