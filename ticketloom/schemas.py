"""Fixed schemas of the relations the operators read and write.

Ids are strings wherever they come from the ticketing API; a property bag is a
``map<string,string>``. Landed JSON is always read with one of these schemas,
never with inference, so an empty landing area still has every column.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_STRING = T.StringType()
_TIME = T.TimestampType()
PROPERTIES = T.MapType(_STRING, _STRING)

# Column and property names as the warehouse and the API give them.

# Warehouse tables.
TICKET_MART = _struct(
    ("ticket_id", _STRING),
    ("create_date", _TIME),
    ("subject", _STRING),
    ("pipeline_name", _STRING),
    ("source_type", _STRING),
)
TICKET_RAW = _struct(
    ("id", _STRING),
    ("property_subject", _STRING),
    ("property_content", _STRING),
    ("property_createdate", _TIME),
    ("property_hs_lastmodifieddate", _STRING),
    ("property_hubspot_owner_id", _STRING),
    ("property_hs_pipeline", _STRING),
    ("property_hs_pipeline_stage", _STRING),
)

# Landed API responses, one JSON document per response.
PAGING = _struct(("next", _struct(("after", _STRING))))
API_OBJECT = _struct(
    ("id", _STRING),
    ("properties", PROPERTIES),
    ("archived", T.BooleanType()),
)
# ``after`` is the cursor the page was requested with, NULL for the first page.
TICKET_PAGE = _struct(
    ("after", _STRING),
    ("results", T.ArrayType(API_OBJECT)),
    ("paging", PAGING),
)
ASSOCIATION_ITEM = _struct(
    ("id", _STRING),
    ("associationTypeId", _STRING),
    ("associationCategory", _STRING),
)
# One response per ticket and page; ``status`` is 'ok' or the reason the read failed. ``page``
# counts a ticket's pages from 0 (NULL: 0), ``after`` is the cursor the page was requested with.
ASSOCIATION_PAGE = _struct(
    ("ticket_id", _STRING),
    ("page", T.LongType()),
    ("after", _STRING),
    ("status", _STRING),
    ("results", T.ArrayType(ASSOCIATION_ITEM)),
    ("paging", PAGING),
)
BATCH_RESULT = _struct(
    ("from", _struct(("id", _STRING))),
    ("to", T.ArrayType(ASSOCIATION_ITEM)),
    ("paging", PAGING),
)
BATCH_RESPONSE = _struct(
    ("page", T.LongType()),
    ("status", _STRING),
    ("results", T.ArrayType(BATCH_RESULT)),
)

# Flat relations produced by the operators.
SUPPORT_TICKET = _struct(
    ("ticket_id", _STRING),
    ("creation_date", _TIME),
    ("ticket_subject", _STRING),
    ("ticket_content", _STRING),
)
ASSOCIATION = _struct(
    ("ticket_id", _STRING),
    ("association_id", _STRING),
    ("association_type", _STRING),
    ("association_category", _STRING),
)
EMAIL = _struct(
    ("id", _STRING),
    ("hs_email_subject", _STRING),
    ("hs_email_text", _STRING),
    ("hs_email_html", _STRING),
    ("hs_timestamp", _STRING),
)
TICKET_EMAIL = _struct(
    ("ticket_id", _STRING),
    ("association_id", _STRING),
    ("subject", _STRING),
    ("content", _STRING),
    ("timestamp", _STRING),
)
COMPARISON = _struct(
    ("ticket_id", _STRING),
    ("ticket_subject", _STRING),
    ("email_subject", _STRING),
    ("email_text", _STRING),
    ("email_html", _STRING),
)

# Properties asked of the API for a ticket and for an e-mail.
TICKET_PROPERTIES = (
    "hs_ticket_id",
    "subject",
    "hs_ticket_priority",
    "createdate",
    "hs_pipeline",
    "hs_pipeline_stage",
)
EMAIL_PROPERTIES = ("hs_email_subject", "hs_email_text", "hs_email_html", "hs_timestamp")
