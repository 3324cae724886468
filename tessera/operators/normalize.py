"""Raw documents: projection, validation, envelopes and their outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import ERROR_FIELD, SOURCES
from tessera.functions.dates import iso_date
from tessera.functions.keys import natural_key
from tessera.functions.text import has_content, is_challenge, strip, url_quote
from tessera.schemas import ENVELOPE, RAW_DOCUMENT, SEARCH_ROWS

PAGE_PATH = "/arama/getDokuman?id="


def raw_documents(rows: DataFrame, base_url: str, source: Column | str = SOURCES[0], keep: tuple[str, ...] = ()) -> DataFrame:
    """Index rows with a text become raw documents; rows whose stripped text is empty are dropped.

    Columns named in ``keep`` go along. A column mevzuatNo, where there is one, is the statute number.
    """
    source = F.lit(source) if isinstance(source, str) else source
    none = F.lit(None).cast("string")
    text = strip(F.col("text"))
    return rows.where(has_content(F.col("text"))).select(
        F.concat(source, F.lit(":"), F.col("id")).alias("id"),
        source.alias("kaynak"),
        F.concat(F.lit(base_url + PAGE_PATH), F.col("id")).alias("url"),
        text.alias("text"),
        F.col("esasNo").alias("esas_no"),
        F.col("kararNo").alias("karar_no"),
        F.col("daireKurul").alias("daire"),
        iso_date(F.col("kararTarihi")).alias("karar_tarihi"),
        (F.col("mevzuatNo") if "mevzuatNo" in rows.columns else none).alias("mevzuat_no"),
        none.alias("resmi_gazete_tarihi"),
        none.alias("mevzuat_turu"),
        F.struct(F.col("id").alias("doc_id"), F.col("arananKelime").alias("aranan_kelime")).alias("metadata"),
        *keep,
    )


def fetch_address(base_url: str, doc_id: Column, keyword: Column) -> Column:
    """Where a page is fetched from: id and keyword are quoted, a missing keyword is one space."""
    return F.concat(F.lit(f"{base_url}/getDokuman?id="), url_quote(doc_id), F.lit("&arananKelime="), url_quote(keyword))


def document_key() -> Column:
    return natural_key(F.col("kaynak"), F.col("esas_no"), F.col("karar_no"), F.col("mevzuat_no"), F.col("url"))


def problem(sources: tuple[str, ...] = SOURCES) -> Column:
    """Why a raw document is invalid; null for a valid one."""
    return (
        F.when(F.col("id").isNull(), "id is missing")
        .when(~F.coalesce(F.col("kaynak").isin(*sources), F.lit(False)), "kaynak is not a known source")
        .when(F.col("url").isNull(), "url is missing")
        .when(F.col("text").isNull(), "text is missing")
    )


def split_valid(docs: DataFrame, sources: tuple[str, ...] = SOURCES) -> tuple[DataFrame, DataFrame]:
    """Valid documents, and the others with their error."""
    checked = docs.withColumn(ERROR_FIELD, problem(sources))
    return checked.where(F.col(ERROR_FIELD).isNull()).drop(ERROR_FIELD), checked.where(F.col(ERROR_FIELD).isNotNull())


def strict_texts(payload: Column, names: list[str]) -> Column:
    """Whether the named JSON fields are texts, null or missing: numbers and booleans are not made into texts."""
    parsed = F.try_parse_json(payload)
    kinds = [F.coalesce(F.schema_of_variant(F.try_variant_get(parsed, f"$.{n}", "variant")), F.lit("VOID")) for n in names]
    return F.forall(F.array(*kinds), lambda k: k.isin("STRING", "VOID"))


#: Fields of a raw document that must be texts, null or missing.
TEXTS = ("id", "kaynak", "url", "text", "esas_no", "karar_no", "daire", "karar_tarihi", "mevzuat_no", "resmi_gazete_tarihi", "mevzuat_turu")


def checked_payloads(payloads: DataFrame, payload: str = "value", sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """JSON payloads as raw documents, with the payload, its other columns, and why it is invalid (null where valid).

    What is no JSON object, and fields of another type, are found before missing fields and unknown sources.
    Columns of the payload's table must not be named as fields of a document.
    """
    kind = F.schema_of_variant(F.try_parse_json(F.col(payload)))
    shape = F.when(~F.coalesce(F.startswith(kind, F.lit("OBJECT")), F.lit(False)), "not a JSON object").when(~strict_texts(F.col(payload), list(TEXTS)), "a field is not a text")
    parsed = payloads.select("*", shape.alias("_shape"), F.from_json(payload, RAW_DOCUMENT).alias("_d"))
    fields = parsed.select(*payloads.columns, "_shape", "_d.*")
    return fields.withColumn(ERROR_FIELD, F.coalesce("_shape", problem(sources))).drop("_shape")


def rows_of(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows of search responses with their totals; responses without rows give one row of nulls."""
    parsed = payloads.withColumn("_r", F.from_json(payload, ENVELOPE))
    found = F.coalesce(F.col("_r.data.data"), F.array().cast(SEARCH_ROWS))
    kept = [c for c in payloads.columns if c != payload]
    return parsed.select(
        *kept, F.coalesce("_r.data.recordsTotal", F.lit(0)).alias("records_total"), F.coalesce("_r.data.recordsFiltered", F.lit(0)).alias("records_filtered"), F.inline_outer(found)
    )


def classify_response(status: Column, kind: Column, message: Column) -> Column:
    """What a response means: ok, error, captcha, backoff, http_error, or network where there was none."""
    return (
        F.when(status.isNull(), "network")
        .when((status == 200) & (F.coalesce(kind, F.lit("")) == "ERROR") & is_challenge(message), "captcha")
        .when((status == 200) & (F.coalesce(kind, F.lit("")) == "ERROR"), "error")
        .when(status == 200, "ok")
        .when(status.isin(429, 503), "backoff")
        .otherwise("http_error")
    )


def crawl_meta(rows: DataFrame, description: str, ts: Column | None = None) -> DataFrame:
    """A provenance row per new id."""
    return rows.select((F.unix_timestamp() if ts is None else ts).cast("long").alias("ts"), F.col("id").cast("string").alias("id"), F.lit(description).alias("crawl_desc"))
