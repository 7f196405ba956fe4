"""npm publish documents and upload form fields.

Documents are edited as text (``json_text``), as no built-in JSON expression writes a document back unchanged; forms
are flattened by built-in expressions.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import json_text as JT
from ..functions import paths as P
from .once import evaluated_once

# As in json_text: the functions of this module that run in Python workers are pickled by value.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # older cloudpickle: the package must then be on the workers' path
    pass

NPM_VERSIONS_SCHEMA = "struct<name: string, versions: map<string, struct<dist: struct<tarball: string>>>>"
PARTS_SCHEMA = "body string, close string, versions string, spec string, reason string"
# Fixed values that must equal the source tool's: upload form constants, the form keys kept
# whole and the attachment content type.
FORM_CONSTANTS = {":action": "file_upload", "protocol_version": "1"}
FORM_KEEP_WHOLE = ("gpg_signature", "content")
ATTACHMENT_CONTENT_TYPE = "application/octet-stream"


def parse_npm(docs: DataFrame, col: str = "metadata") -> DataFrame:
    """Parse metadata documents; keeps the raw text next to the parsed struct."""
    return docs.withColumn("_doc", F.from_json(F.col(col), NPM_VERSIONS_SCHEMA))


def npm_missing_metadata(docs: DataFrame, endpoint_col: str = "endpoint") -> DataFrame:
    """Versions that their package's metadata can't publish -> failure rows (status 400 and the reason of
    ``npm_publish_document``, most often ``missing_from_metadata``) instead of an upload."""
    p = with_publish_parts(docs, endpoint_col=endpoint_col).where(F.col("_parts.reason").isNotNull())
    return p.select("doc_id", "repository", "package", "version", F.lit(400).alias("status_code"), F.col("_parts.reason").alias("reason"))


def _drop_rev(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: JT.without(t, ("_rev",)), na_action="ignore")


def npm_drop_rev(docs: DataFrame, col: str = "metadata") -> DataFrame:
    """The document without ``_rev``, everything else as it stands (``publish_doc``); NULL where it is not an object."""
    return docs.withColumn("publish_doc", F.pandas_udf(_drop_rev, "string")(col))


def _publish_parts(texts: pd.Series, versions: pd.Series, tarballs: pd.Series) -> pd.DataFrame:
    none = lambda x: x if isinstance(x, str) else None
    found = [JT.publish_parts(none(t), none(v), none(u)) for t, v, u in zip(texts, versions, tarballs)]
    return pd.DataFrame(found, columns=["body", "close", "versions", "spec", "reason"], dtype=object)


def tarball_url(endpoint_col: str = "endpoint") -> F.Column:
    """``<endpoint><package>/<file name>`` at the target."""
    return F.concat(P.endpoint_folder(endpoint_col), F.col("package"), F.lit("/"), P.basename(P.npm_tarball_name("package", "version")))


def with_publish_parts(docs: DataFrame, col: str = "metadata", endpoint_col: str = "endpoint") -> DataFrame:
    """``_parts``: the edited text of each document (``json_text.publish_parts``), one pass over each text."""
    return evaluated_once(docs, _parts=F.pandas_udf(_publish_parts, PARTS_SCHEMA)(col, "version", tarball_url(endpoint_col)))


def npm_single_version(docs: DataFrame, endpoint_col: str = "endpoint") -> DataFrame:
    """I4: ``versions_kept``, the text of ``versions`` with only the version being published, all its fields kept."""
    return with_publish_parts(docs, endpoint_col=endpoint_col).withColumn("versions_kept", F.col("_parts.versions")).drop("_parts")


def npm_set_tarball(docs: DataFrame, endpoint_col: str = "endpoint") -> DataFrame:
    """``version_spec``, the version's text with ``dist.tarball`` at the target; NULL when the version is missing."""
    return with_publish_parts(docs, endpoint_col=endpoint_col).withColumn("version_spec", F.col("_parts.spec")).drop("_parts")


def npm_publish_document(docs: DataFrame, content_col: str | None = None, endpoint_col: str = "endpoint", col: str = "metadata") -> DataFrame:
    """The whole document to publish (``document``), or why there is none (``reason``).

    Without ``_rev``, with the one version, its tarball address and, given ``content_col`` (the tarball's bytes), the
    attachment last; every other character of the metadata stays as it is: key order, white space, numbers of any
    length.  Of repeated keys the last counts.  Reasons: ``no_metadata``, ``invalid_json``, ``missing_from_metadata``
    (D8: no such version or an empty one), ``no_dist``, and ``no_content`` where the bytes are null.  The bytes never
    leave the JVM: the text is cut in two before the attachment and joined again here.
    """
    out = with_publish_parts(docs, col, endpoint_col)
    p, reason, attached = F.col("_parts"), F.col("_parts.reason"), F.lit("")
    if content_col is not None:
        entry = F.to_json(F.create_map(P.npm_tarball_name("package", "version"), npm_attachment(F.col(content_col))))
        attached = F.concat(F.lit(',"_attachments":'), entry)
        reason = F.coalesce(reason, F.when(F.col(content_col).isNull(), F.lit("no_content")))
    text = F.concat(p["body"], attached, p["close"])
    return out.withColumn("document", F.when(reason.isNull(), text)).withColumn("reason", reason).drop("_parts")


def npm_attachment(content_col, length_col=None) -> F.Column:
    """``_attachments`` entry -- content type, base64 data on one line, length as text."""
    data = F.regexp_replace(F.base64(content_col), r"[\r\n]", "")
    length = F.octet_length(content_col) if length_col is None else length_col
    return F.struct(
        F.lit(ATTACHMENT_CONTENT_TYPE).alias("content_type"),
        data.alias("data"),
        length.cast("string").alias("length"),
    )


def _parsed_forms(forms: DataFrame, col: str) -> DataFrame:
    """Each form once more as a map of exact value texts and a map of typed values; both NULL unless it is an object."""
    typed = F.try_parse_json(F.col(col))
    ok = F.schema_of_variant(typed).startswith("OBJECT")
    reason = (F.when(F.col(col).isNull() | (F.trim(F.col(col)) == ""), F.lit("no_form"))
              .when(typed.isNull(), F.lit("invalid_json")).when(~ok, F.lit("not_an_object")))
    return forms.select(
        "doc_id", reason.alias("reason"),
        F.when(ok, F.from_json(F.col(col), "map<string, string>")).alias("texts"),
        F.when(ok, F.from_json(F.col(col), "map<string, variant>")).alias("values"),
    )


def form_fields(forms: DataFrame, col: str = "form") -> DataFrame:
    """I1 + I2: flatten upload form metadata into (key, value) pairs.

    The value's type decides: a list gives one pair per item (none when empty), every other value one pair: strings
    as they are, numbers, booleans and objects as JSON text (a decimal's last zeros may go), null as NULL.
    ``gpg_signature`` and ``content`` stay whole (a list as JSON text).  The protocol constants are added and win over a key of the same name, as a dict
    update would.  Forms that are not one JSON object without repeated keys give no
    pairs; ``form_rejects`` names them.
    """
    kept = _parsed_forms(forms, col).where(F.col("reason").isNull())
    kv = kept.select("doc_id", F.explode("texts").alias("key", "text"), "values").where(~F.col("key").isin(*FORM_CONSTANTS))
    is_list = F.schema_of_variant(F.col("values")[F.col("key")]).startswith("ARRAY") & ~F.col("key").isin(*FORM_KEEP_WHOLE)
    items = F.when(is_list, F.from_json(F.col("text"), "array<string>")).otherwise(F.array(F.col("text")))
    pairs = kv.select("doc_id", "key", F.explode(items).alias("value"))
    consts = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in FORM_CONSTANTS.items()])
    return pairs.unionByName(kept.select("doc_id", F.inline(consts)))


def form_rejects(forms: DataFrame, col: str = "form") -> DataFrame:
    """Forms that can't be sent: ``doc_id``, ``reason`` (``no_form``, ``invalid_json`` or ``not_an_object``)."""
    return _parsed_forms(forms, col).where(F.col("reason").isNotNull()).select("doc_id", "reason")
