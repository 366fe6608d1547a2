"""Explicit input schemas; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_SCALARS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}

CORRUPT_COLUMN = "_corrupt_record"


def _record(text: str, **nested: T.DataType) -> T.StructType:
    """Nullable struct from ``name type`` pairs; a nested field is listed as ``name *``."""
    fields = []
    for item in text.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, nested[name] if kind == "*" else _SCALARS[kind], True))
    return T.StructType(fields)


def _list_of(text: str, **nested: T.DataType) -> T.ArrayType:
    return T.ArrayType(_record(text, **nested))


# The column layout of the daily event file, in file order.
EVENT_SCHEMA = _record("""
    GlobalEventID int, SQLDATE string, MonthYear int, Year int, FractionDate double,
    Actor1Code string, Actor1Name string, Actor1CountryCode string, Actor1KnownGroupCode string,
    Actor1EthnicCode string, Actor1Religion1Code string, Actor1Religion2Code string,
    Actor1Type1Code string, Actor1Type2Code string, Actor1Type3Code string,
    Actor2Code string, Actor2Name string, Actor2CountryCode string, Actor2KnownGroupCode string,
    Actor2EthnicCode string, Actor2Religion1Code string, Actor2Religion2Code string,
    Actor2Type1Code string, Actor2Type2Code string, Actor2Type3Code string,
    IsRootEvent int, EventCode string, EventBaseCode string, EventRootCode string, QuadClass int,
    GoldsteinScale double, NumMentions int, NumSources int, NumArticles int, AvgTone double,
    Actor1Geo_Type int, Actor1Geo_FullName string, Actor1Geo_CountryCode string,
    Actor1Geo_ADM1Code string, Actor1Geo_Lat double, Actor1Geo_Long double, Actor1Geo_FeatureID string,
    Actor2Geo_Type int, Actor2Geo_FullName string, Actor2Geo_CountryCode string,
    Actor2Geo_ADM1Code string, Actor2Geo_Lat double, Actor2Geo_Long double, Actor2Geo_FeatureID string,
    ActionGeo_Type int, ActionGeo_FullName string, ActionGeo_CountryCode string,
    ActionGeo_ADM1Code string, ActionGeo_Lat double, ActionGeo_Long double, ActionGeo_FeatureID string,
    DATEADDED int, SOURCEURL string
""")

# The post documents of the three platforms.
_TIKTOK_VIDEO = _record(
    """
    author string, author_id string, challenges *, collected_by string, coverUrl string,
    createTime long, datatype string, definition string, desc string, duetEnabled boolean,
    duration int, format string, id string, isAd boolean, itemCommentStatus string,
    itemMute boolean, lastseents string, music *, officialItem boolean, originalCoverUrl string,
    originalItem boolean, privateobj boolean, secret boolean, shareEnabled boolean,
    showNotPass boolean, stats *, stitchEnabled boolean, subtitleLinks *
    """,
    challenges=_list_of("id string, title string"),
    music=_record("coverMediumUrl string, musicAlbum string, musicAuthor string, musicId string, "
                  "musicName string, musicOriginal boolean, playUrl string"),
    stats=_record("collectCount long, commentCount long, diggCount long, playCount long, shareCount long"),
    subtitleLinks=_list_of("downloadLink string, language string, tiktokLink string"),
)

_FRAME = _record("aspect double, height int, width int, size string")

_TRUTH_SOCIAL = _record(
    """
    account *, card *, content_cleaned string, created_at string, id string, language string,
    favourites_count long, reblogs_count long, replies_count long, visibility string, uri string,
    url string, lastseents string, tags *, mentions *, media_attachments *, collected_by string,
    datatype string, in_reply_to_account_id string, in_reply_to_id string, bookmarked boolean,
    favourited boolean, muted boolean, pinned boolean, reblogged boolean, sensitive boolean,
    sponsored boolean, spoiler_text string, group *
    """,
    account=_record("acct string, display_name string, id string, username string"),
    card=_record("author_name string, author_url string, blurhash string, description string, "
                 "title string, url string, image string, embed_url string, html string, "
                 "provider_name string, provider_url string, type string, height int, width int, "
                 "group string, id string, links string"),
    tags=_list_of("name string, url string"),
    mentions=_list_of("acct string, id string, url string, username string"),
    media_attachments=_list_of(
        "url string, type string, preview_url string, remote_url string, text_url string, "
        "description string, blurhash string, meta *, id string",
        meta=_record("aspect double, height int, width int, size string, original *, small *",
                     original=_FRAME, small=_FRAME),
    ),
    group=_record("display_name string, id string, slug string"),
)

_COUNT = _record("count long")

_VK = _record(
    """
    attachments *, author string, collected_by string, comments *, datatype string, from_id string,
    date long, id string, likes *, post_source *, marked_as_ads int, reposts *, text string,
    type string, views *, wall_owner string, lastseents string
    """,
    attachments=_list_of(
        "type string, link *",
        link=_record("url string, title string, description string, photo *",
                     photo=_record("sizes *", sizes=_list_of("width int, type string, url string, height int"))),
    ),
    comments=_COUNT, likes=_COUNT, reposts=_COUNT, views=_COUNT,
    post_source=_record("type long"),
)


def _envelope(source: T.StructType, *, ranked: bool = False) -> T.StructType:
    """Search-result envelope ``hits.hits[]._source``; the ranked form also carries totals."""
    if ranked:
        hits = _record(
            "total *, max_score string, hits *",
            total=_record("value long, relation string"),
            hits=_list_of("_index string, _id string, _score string, _source *, sort *",
                          _source=source, sort=T.ArrayType(T.LongType())),
        )
    else:
        hits = _record("hits *", hits=_list_of("_index string, _id string, _source *", _source=source))
    return _record("hits *", hits=hits)


POST_SCHEMAS = {
    "truth_social": _envelope(_TRUTH_SOCIAL),
    "tiktok_video": _envelope(_TIKTOK_VIDEO, ranked=True),
    "vk": _envelope(_VK),
}

PLATFORMS = tuple(POST_SCHEMAS)


def get_schema(platform: str) -> T.StructType:
    """Envelope schema of a platform, by case-insensitive name."""
    try:
        return POST_SCHEMAS[platform.lower()]
    except KeyError:
        raise ValueError(f"unknown platform {platform!r}; supported: {', '.join(PLATFORMS)}") from None


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


def ddl(schema: T.StructType) -> str:
    """Schema as the text that ``from_csv`` and ``from_json`` take."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
