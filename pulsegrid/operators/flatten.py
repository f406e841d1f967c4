"""From raw telemetry with JSON properties to flat, clean page views and clicks; no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.tracking import first_id, parse_tracking_id
from pulsegrid.functions.values import label_null, lenient_ts, let, normalize_gpn, to_local_ts

MAP = "map<string,string>"
# The columns of an export that the model drops.
NOISE = (
    "appId", "iKey", "sdkVersion", "itemCount", "itemType", "operation_Id", "operation_ParentId", "operation_Name", "client_IP", "client_Type", "client_Model", "performanceBucket", "name", "url",
    "client_City", "client_StateOrProvince", "cp_NewsCategory",
)
# The names that the model gives to the others.
NAMES = {
    "timestamp [UTC]": "timestamp", "id": "view_id", "user_Id": "user_id", "session_Id": "session_id", "duration": "load_ms", "cp_refUri": "ref_uri", "client_OS": "client_os", "client_Browser": "client_browser",
    "client_CountryOrRegion": "client_country", "cp_PageId": "page_id", "cp_Email": "email", "cp_GPN": "gpn", "cp_PageName": "page_name", "cp_PageURL": "page_url", "cp_SiteID": "site_id", "cp_SiteName": "site_name",
    "cp_ContentOwner": "content_owner", "cp_ContentType": "content_type", "cp_Theme": "theme", "cp_Topic": "topic", "cp_TargetRegion": "target_region", "cp_TargetOrganisation": "target_org", "cp_PageStatus": "page_status",
    "cp_PublishingDate": "publishing_date",
}
# The properties of a page view.
PAGE_PROPERTIES = ("SiteID", "SiteName", "PageId", "PageName", "PageStatus", "PageURL", "PublishingDate", "TrackingID", "ContentOwner", "ContentType", "NewsCategory", "Theme", "Topic", "TargetOrganisation", "TargetRegion", "GPN", "Email", "refUri")
# The properties of a click event.
CLICK_PROPERTIES = (
    "GPN", "Email", "SiteID", "SiteName", "PageId", "PageName", "PageURL", "PageStatus", "ContentType", "ContentOwner", "NewsCategory", "PublishingDate", "ComponentName",
    "Link_Type", "Link_label", "Link_address", "Link_ancestors", "FileType_Label", "FileName_Label", "Theme", "Topic", "TargetOrganisation", "TargetRegion", "refUri",
    "Video_Action", "Video_Id", "Video_Type", "Video_Duration",
)
ID_KEY = "trackingid"  # how the plain form of a property that holds a tracking id ends; what stands before differs by source


def parse_custom_dimensions(c: str | Column) -> Column:
    """A property cell as a map: an object, or a JSON string that holds one; CustomProps, nested as an object or as
    a string, with keys cp_*; a broken CustomProps as cp_raw; a broken or empty cell as an empty map.

    The cell is parsed once, and CustomProps once more."""
    raw, none = F.trim(F.col(c) if isinstance(c, str) else c), F.create_map().cast(MAP)
    cell = F.from_json(F.when(raw.startswith("{"), raw).otherwise(F.get_json_object(raw, "$")), MAP)

    def whole(x: Column) -> Column:
        nested, inner = x["nested"], x["inner"]
        marked = F.transform_keys(inner, lambda k, v: F.concat(F.lit("cp_"), k))
        props = F.when(nested.isNull() | (nested == ""), none).when(F.size(inner) > 0, marked).otherwise(F.create_map(F.lit("cp_raw"), nested))
        return F.map_concat(F.map_filter(x["top"], lambda k, v: k != "CustomProps"), props)

    def opened(top: Column) -> Column:
        nested = top["CustomProps"]
        return let(F.struct(top.alias("top"), nested.alias("nested"), F.coalesce(F.from_json(F.when(nested.startswith("{"), nested), MAP), none).alias("inner")), whole)

    return let(F.coalesce(cell, none), opened)


def property_keys(df: DataFrame, col: str = "props") -> list[str]:
    """The distinct keys of a map column: one pass; keys are a schema, so they are few."""
    return sorted(r.k for r in df.select(F.explode(F.map_keys(col)).alias("k")).distinct().collect())


def _plain(key: Column) -> Column:
    return F.lower(F.translate(key, " _", ""))


def plain_name(key: str) -> str:
    """A key without blanks and underscores in lower case, as plain_keys has it."""
    return key.lower().replace(" ", "").replace("_", "")


def plain_keys(props: str | Column) -> Column:
    """The map with keys in lower case, without blanks and underscores; of several alike the first with a value that is not
    blank stays, or else the first."""

    def first(x: Column) -> Column:
        at = lambda keys, e: F.array_position(x[keys], e["key"])
        return F.map_from_entries(F.filter(x["entries"], lambda e, i: F.when(at("filled", e) > 0, at("filled", e)).otherwise(at("keys", e)) == i + 1))

    entries = F.transform(F.map_entries(F.col(props) if isinstance(props, str) else props), lambda e: F.struct(_plain(e["key"]).alias("key"), e["value"].alias("value")))
    filled = lambda e: F.transform(e, lambda x: F.when(F.trim(x["value"]) != "", x["key"]).otherwise(F.lit(" ")))  # noqa: E731  no plain key is a blank
    return let(let(entries, lambda e: F.struct(e.alias("entries"), F.transform(e, lambda x: x["key"]).alias("keys"), filled(e).alias("filled"))), first)


def pick(props: str | Column, key: str) -> Column:
    """The value of a key, matched without regard to case, blanks and underscores."""
    return F.try_element_at(plain_keys(props), F.lit(plain_name(key)))


def tracking_value(plain: str | Column, key: str = "cp_TrackingID") -> Column:
    """The tracking id of a map with plain keys: the first value that is not blank or a spelling of nothing, of the key itself
    and then of all keys that end in `trackingid`, in the order of their names; without any, what the key itself holds."""
    plain = F.col(plain) if isinstance(plain, str) else plain
    own = F.try_element_at(plain, F.lit(plain_name(key)))
    others = F.map_values(F.map_from_entries(F.array_sort(F.map_entries(F.map_filter(plain, lambda k, v: k.endswith(ID_KEY))))))
    return F.coalesce(F.when(first_id(own).isNotNull(), own), F.get(F.filter(others, lambda v: first_id(v).isNotNull()), 0), own)


def flatten_props(df: DataFrame, keys: list[str] | tuple[str, ...] | None = None, col: str = "props") -> DataFrame:
    """One column for each key, matched without regard to case, blanks and underscores; without keys, for those found in
    the data.  A key that ends in `trackingid` takes its value from whichever property of that ending has one."""
    rest = [f"`{c}`" for c in df.columns if c != col]
    if keys is None:
        return df.select(*rest, *(F.col(col)[k].alias(k) for k in property_keys(df, col)))
    plain = df.withColumn(col, plain_keys(col))
    value = lambda k: tracking_value(col, k) if plain_name(k).endswith(ID_KEY) else F.try_element_at(col, F.lit(plain_name(k)))
    return plain.select(*rest, *(value(k).alias(k) for k in keys))


def flatten_page_views(df: DataFrame, start: str, end: str, ts: str = "timestamp [UTC]", properties: tuple[str, ...] = PAGE_PROPERTIES) -> DataFrame:
    """Page views of a time window with their page properties as columns.  For a listing, sort by newest_first."""
    when = F.try_to_timestamp(F.col(f"`{ts}`").cast("string"))
    inside = df.filter(when.between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))).withColumn("props", parse_custom_dimensions("customDimensions")).drop("customDimensions")
    return flatten_props(inside, [f"cp_{p}" for p in properties])


def flatten_click_events(df: DataFrame, start: str, end: str, ts: str = "timestamp") -> DataFrame:
    """Click events of a time window with their click properties as columns.  For a listing, sort by newest_first."""
    inside = df.filter((F.col("name") == "click_event") & F.col(ts).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
    inside = inside.withColumn("props", parse_custom_dimensions("customDimensions")).drop("customDimensions")
    return flatten_props(inside, [f"cp_{p}" for p in CLICK_PROPERTIES])


def newest_first(df: DataFrame, ts: str) -> DataFrame:
    return df.orderBy(F.desc(f"`{ts}`"), "id")


def clean_page_views(df: DataFrame) -> DataFrame:
    """Noise dropped, names as in the model, times local, dates and person numbers tidy, tracking id split."""
    df = df.drop(*NOISE).withColumnsRenamed({k: v for k, v in NAMES.items() if k in df.columns})
    ids = [c for c in df.columns if c.lower().startswith("cp_") and plain_name(c).endswith(ID_KEY)]  # spellings differ
    fixes = {"timestamp": to_local_ts("timestamp")}
    if "publishing_date" in df.columns:
        fixes["publishing_date"] = lenient_ts("publishing_date")
    if "gpn" in df.columns:
        fixes["gpn"] = normalize_gpn("gpn")
    df = df.withColumns(fixes)
    return parse_tracking_id(df, *ids).drop(*ids) if ids else df


def strip_identity(df: DataFrame) -> DataFrame:
    """Without person number and e-mail; the anonymous user and the organisation stay."""
    return df.drop("gpn", "email", "cp_GPN", "cp_Email")


def anonymize_clicks(df: DataFrame, secret: str) -> DataFrame:
    """The person number as a keyed SHA-256; no e-mail.  The secret comes from the caller's configuration."""
    return df.withColumn("person_hash", F.when(F.col("gpn").isNotNull(), F.sha2(F.concat(F.lit(secret), F.col("gpn")), 256))).drop("gpn", "email")


def with_view_date_hour(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns({"view_date": F.to_date(ts), "view_hour": F.hour(ts)})


def label_nulls(df: DataFrame, *cols: str, label: str = "(Unknown)") -> DataFrame:
    return df.withColumns({c: label_null(c, label) for c in cols})
