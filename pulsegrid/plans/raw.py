"""Raw telemetry rows, with properties as JSON text, packed from the flat model tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _packed(props: dict, by: F.Column) -> F.Column:
    """CustomProps as an object, as a JSON string, or the whole cell encoded twice, by row."""
    inner = F.to_json(F.struct(*(c.alias(k) for k, c in props.items())))
    plain = F.concat(F.lit('{"CustomProps":'), inner, F.lit(',"env":"prod"}'))
    text = F.to_json(F.struct(inner.alias("CustomProps"), F.lit("prod").alias("env")))
    twice = F.get_json_object(F.to_json(F.struct(F.array(plain).alias("a"))), "$.a[*]")
    return F.when(by == 0, plain).when(by == 1, text).otherwise(twice)


def _ids() -> dict:
    """The tracking id under one of two prefixed names, of which the other is blank or missing, by row."""
    turn = F.pmod(F.substring("view_id", 2, 20).cast("long"), F.lit(4))
    return {"CampaignTrackingID": F.when(turn < 2, F.col("tracking_id")).when(turn == 2, F.lit(" ")), "Campagne Tracking_ID": F.when(turn >= 2, F.col("tracking_id"))}


def raw_page_views(t: dict[str, DataFrame]) -> DataFrame:
    v = t["page_views"]
    c = F.col
    props = {"SiteID": c("site_id"), "SiteName": c("site_name"), "PageId": c("page_id"), "PageName": c("page_name"), "PageURL": c("url"), "Theme": c("theme"), "ContentType": c("content_type"), "GPN": c("gpn").cast("string"), **_ids()}
    return v.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp [UTC]"), c("view_id").alias("id"), F.lit("pageView").alias("name"), "url", c("load_ms").alias("duration"), F.lit("<250ms").alias("performanceBucket"),
        c("session_id").alias("session_Id"), c("user_id").alias("user_Id"), F.lit("Browser").alias("client_Type"), F.lit("app").alias("appId"), F.lit(1).alias("itemCount"), "source_file",
        _packed(props, F.pmod(F.substring("view_id", 2, 20).cast("long"), F.lit(3))).alias("customDimensions"),
    )


def raw_custom_events(t: dict[str, DataFrame]) -> DataFrame:
    c = F.col
    props = {"GPN": c("gpn"), "Email": c("email"), "PageId": c("page_id"), "Link_Type": c("link_type"), "ComponentName": c("component")}
    return t["custom_events"].select(c("event_id").alias("id"), c("ts").alias("timestamp"), "name", c("user_id").alias("user_Id"), c("session_id").alias("session_Id"), _packed(props, F.pmod(F.substring("event_id", 2, 20).cast("long"), F.lit(3))).alias("customDimensions"))
