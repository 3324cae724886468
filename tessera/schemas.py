"""Record layouts, as Spark DDL."""

from __future__ import annotations

INDEX_ROW = ("id STRING, daireKurul STRING, esasNo STRING, kararNo STRING, kararTarihi STRING, arananKelime STRING, _corrupt_record STRING")
CRAWL_META = ("ts LONG, id STRING, crawl_desc STRING")
SEARCH_ROWS = "array<struct<id: string, daireKurul: string, esasNo: string, kararNo: string, kararTarihi: string, arananKelime: string>>"
ENVELOPE = f"metadata STRUCT<FMTY: STRING, FMTE: STRING>, data STRUCT<data: {SEARCH_ROWS}, recordsTotal: LONG, recordsFiltered: LONG>"
RAW_DOCUMENT = (
    "id STRING, kaynak STRING, url STRING, text STRING, esas_no STRING, karar_no STRING, daire STRING, karar_tarihi STRING, mevzuat_no STRING, "
    "resmi_gazete_tarihi STRING, mevzuat_turu STRING, fetched_at TIMESTAMP_NTZ, metadata STRUCT<doc_id: STRING, aranan_kelime: STRING>"
)
CHUNK = (
    "chunk_id STRING, doc_id STRING, kaynak STRING, text STRING, chunk_index INT, total_chunks INT, esas_no STRING, karar_no STRING, daire STRING, "
    "karar_tarihi STRING, mevzuat_no STRING, mevzuat_turu STRING, url STRING, metadata MAP<STRING, STRING>"
)
MESSAGE = ("topic STRING, key STRING, value STRING")
