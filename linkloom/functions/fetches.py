"""Classes of fetched responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.constants import MIME_CLASSES, MIME_UNKNOWN, RETRIED_STATUSES


def mime_class(content_type: Column) -> Column:
    """First class whose MIME fragment occurs, case-sensitive; UNKNOWN otherwise, also for NULL."""
    (fragment, code), *rest = MIME_CLASSES
    branches = F.when(content_type.contains(fragment), code)
    for fragment, code in rest:
        branches = branches.when(content_type.contains(fragment), code)
    return branches.otherwise(MIME_UNKNOWN)


def failed(status: Column, body: Column) -> Column:
    """A fetch with no body, or with a status that is retried until it fails."""
    return body.isNull() | F.coalesce(status.isin(*RETRIED_STATUSES), F.lit(False))


def fetch_class(url: Column, status: Column, content_type: Column, body: Column) -> Column:
    """Class of a response: NULL if it failed, BINARY for ``.pdf`` URLs, else the MIME class."""
    return (
        F.when(failed(status, body), F.lit(None).cast("string"))
        .when(url.endswith(".pdf"), "BINARY")
        .otherwise(mime_class(content_type))
    )


def stored_type(klass: Column) -> Column:
    """Page state after the fetch: HTML only for HTML responses, BINARY for all others."""
    return F.when(klass == "HTML", "HTML").otherwise("BINARY")
