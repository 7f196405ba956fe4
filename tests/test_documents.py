"""npm publish documents and upload forms: edited text byte by byte, types, rejects."""

import json
import random

from pyspark.sql import functions as F

from pkgsync.functions import json_text as JT
from pkgsync.operators import documents as DOC

SPEC = '{"name":"p","deps":{"a":"^1"},"big":' + "9" * 41 + ',"w":1.0, "dist" : {"shasum":"x","tarball":"old"} }'
DOC_TEXT = ('{ "_rev" : "1-x", "name":"p\\"é", "n":1.0,"versions": {"0.1":{"dist":{}},"1.0":' + SPEC
            + ',"2.0":{}, "3":null}, "z":[1e400,-0.0], "_attachments":{"a":1} }\n')


def _published(spark, rows, content=b"abc"):
    df = spark.createDataFrame([(i, "@s/p", v, t, content) for i, (v, t) in enumerate(rows)],
                               "doc_id long, package string, version string, metadata string, content binary").withColumn("endpoint", F.lit("http://e"))
    return [(r["document"], r["reason"]) for r in DOC.npm_publish_document(df, "content").orderBy("doc_id").collect()]


def test_publish_document_leaves_all_other_text_as_it_is(spark):
    (got, reason), = _published(spark, [("1.0", DOC_TEXT)])
    assert reason is None
    assert got == ('{ "name":"p\\"é", "n":1.0,"versions": {"1.0":' + SPEC.replace('"old"', '"http://e/@s/p/p-1.0.tgz"') + '}, "z":[1e400,-0.0]'
                   ',"_attachments":{"@s/p-1.0.tgz":{"content_type":"application/octet-stream","data":"YWJj","length":"3"}} }\n')
    # without bytes asked for, no attachment
    df = spark.createDataFrame([("p", "1.0", DOC_TEXT, "e/")], "package string, version string, metadata string, endpoint string")
    assert "_attachments" not in DOC.npm_publish_document(df).first()["document"]


def test_publish_document_rejects_with_a_reason(spark):
    cases = [("9", DOC_TEXT, "missing_from_metadata"), ("2.0", DOC_TEXT, "missing_from_metadata"), ("3", DOC_TEXT, "missing_from_metadata"),
             ("1", "{}", "missing_from_metadata"), ("1", '{"versions":[]}', "missing_from_metadata"), ("1.0", DOC_TEXT[:-9], "invalid_json"),
             ("1.0", '{"versions":{"1.0":{"a":NaN}}}', "invalid_json"), ("1.0", "[1]", "invalid_json"), ("1.0", "{} x", "invalid_json"),
             ("1.0", "[" * 100_000, "invalid_json"), ("1.0", None, "no_metadata"), ("1.0", "  ", "no_metadata"), ("1.0", '{"versions":{"1.0":{"x":1}}}', "no_dist")]
    assert _published(spark, [c[:2] for c in cases]) == [(None, c[2]) for c in cases]
    assert _published(spark, [("1.0", DOC_TEXT)], None) == [(None, "no_content")]


def test_repeated_keys_count_as_the_last(spark):
    text = '{"versions":{"1":{"dist":{"tarball":"a"}}},"_rev":1,"versions":{"1":{"x":0},"1":{"dist":{"tarball":"b"},"dist":{"tarball":"c","tarball":"d"}}},"_rev":2}'
    (got, _), = _published(spark, [("1", text)])
    assert json.loads(got, object_pairs_hook=list)[0] == ("versions", [("1", [("dist", [("tarball", "http://e/@s/p/p-1.tgz")])])])


def test_cutting_members_equals_parsing_on_random_objects():
    r = random.Random(3)
    space = lambda: r.choice(["", "", " ", "\n "])
    for _ in range(400):
        kept = {k: r.choice(["1", '"a,}"', "[1, 2]", '{"k": {}}', "null"]) for k in r.sample("abcdef", r.randint(0, 6))}
        text = "{" + space() + ",".join(f'{space()}"{k}"{space()}:{space()}{v}{space()}' for k, v in kept.items()) + "}"
        drop = tuple(r.sample("abcdef", r.randint(0, 4)))
        assert json.loads(JT.without(text, drop)) == {k: json.loads(v) for k, v in kept.items() if k not in drop}
        assert JT.without(text, ()) == text
    assert JT.without('{"a":1', ("a",)) is None and JT.without(None, ("a",)) is None


def test_single_version_and_tarball_keep_every_field(spark):
    df = spark.createDataFrame([("p", "1.0", DOC_TEXT, "e")], "package string, version string, metadata string, endpoint string")
    assert DOC.npm_single_version(df).first()["versions_kept"] == '{"1.0":' + SPEC + "}"
    assert DOC.npm_set_tarball(df).first()["version_spec"] == SPEC.replace('"old"', '"e/p/p-1.0.tgz"')
    assert DOC.npm_drop_rev(df).first()["publish_doc"] == DOC_TEXT.replace('"_rev" : "1-x", ', "")


def test_form_fields_by_type_and_rejects(spark):
    form = ('{"name":["p"],"v":"x","n":1.0,"big":' + "1" * 41 + ',"nul":null,"b":true,"l":["a",null,2.5,{"k":1.0}],"e":[],"content":["x","y"],"o":{"a":[1]},'
            '":action":["q"],"gpg_signature":"s","s":"[1]"}')
    rows = [(1, form), (2, '{"a":'), (3, "[1]"), (4, None), (5, " "), (6, '{"a":1,"a":2}'), (7, "{}"), (8, "3")]
    df = spark.createDataFrame(rows, "doc_id bigint, form string")
    got = sorted(((r["doc_id"], r["key"], r["value"]) for r in DOC.form_fields(df).collect()), key=str)
    assert got == sorted([
        (1, ":action", "file_upload"), (1, "protocol_version", "1"), (1, "name", "p"), (1, "v", "x"), (1, "n", "1.0"), (1, "big", "1" * 41), (1, "nul", None),
        (1, "b", "true"), (1, "l", "a"), (1, "l", None), (1, "l", "2.5"), (1, "l", '{"k":1.0}'), (1, "content", '["x","y"]'), (1, "o", '{"a":[1]}'),
        (1, "gpg_signature", "s"), (1, "s", "[1]"), (7, ":action", "file_upload"), (7, "protocol_version", "1")], key=str)
    assert sorted((r["doc_id"], r["reason"]) for r in DOC.form_rejects(df).collect()) == [
        (2, "invalid_json"), (3, "not_an_object"), (4, "no_form"), (5, "no_form"), (6, "invalid_json"), (8, "not_an_object")]
    assert DOC.form_fields(df.limit(0)).count() == 0
