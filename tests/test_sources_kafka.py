"""Sources, listing URLs, broker settings, publishing."""

import json

import pytest
from pyspark.sql import functions as F

from jobloom.functions.urls import strip_tracking
from jobloom.plans.payload import PayloadTooLarge
from jobloom.plans.produce import gather_records, single_message
from jobloom.sinks import kafka as K
from jobloom.sources import config as SRC
from jobloom.sources import messages as MSG
from jobloom.sources import pages as PG

LISTINGS = [{"id": "north", "url": "http://north.test/work?team=1"}, {"url": "https://South.test:8443/work", "origin": "https://apply.south.test//"},
            {"id": "west", "url": "https://west.test"}]


def test_one_listing_names_itself(spark):
    row = SRC.load_sources(spark, None, "http://solo.test:81/list#top").collect()
    assert [tuple(r[c] for c in ("pos", "id", "url", "origin")) for r in row] == [
        (0, "http://solo.test:81", "http://solo.test:81/list#top", "http://solo.test:81")]


def test_listings_from_json(spark):
    rows = {r["url"]: r for r in SRC.load_sources(spark, json.dumps(LISTINGS)).collect()}
    assert rows[LISTINGS[0]["url"]]["origin"] == "http://north.test"
    assert rows[LISTINGS[1]["url"]]["origin"] == "https://apply.south.test"
    assert rows[LISTINGS[2]["url"]]["id"] == "west"


@pytest.mark.parametrize("settings", ["", "[]", "{", "[3]", json.dumps([{"url": "file:///etc/hosts"}]), json.dumps([{"id": "n", "url": ""}]),
                                      json.dumps([LISTINGS[0], {"url": "gopher://old.test"}])])
def test_listings_that_cannot_be_used(spark, settings):
    with pytest.raises(ValueError):
        SRC.load_sources(spark, settings).collect()


@pytest.mark.parametrize("first, more, found", [
    ("u", None, ["u"]), ("u", "", ["u"]), (" u", "v,u,,\tw ", ["u", "v", "w"]), (None, "v", ["v"]), ("", " , ", []),
])
def test_listing_urls(spark, first, more, found):
    df = spark.createDataFrame([(first, more)], "a string, b string")
    assert [r["listing_url"] for r in SRC.listing_urls(df, "a", "b").orderBy("pos").collect()] == found


def test_pages_meet_their_sources(spark):
    pages = spark.createDataFrame([(n, s["url"], f'<p><a href="/career/post-{n}">Post {n}</a>') for n, s in enumerate(LISTINGS[:2])]
                                  + [(9, "http://unknown.test", '<a href="/career/stray">Stray</a>')], "page_id long, url string, html string")
    sources = SRC.load_sources(spark, json.dumps(LISTINGS))
    found = {(r["source"], r["job_url"]) for r in gather_records(pages, sources, on="url").collect()}
    assert found == {("north", "http://north.test/career/post-0"), ("https://south.test:8443", "https://apply.south.test/career/post-1")} or \
        found == {("north", "http://north.test/career/post-0"), ("https://South.test:8443", "https://apply.south.test/career/post-1")}
    assert [r["id"] for r in SRC.sources_without_pages(pages, sources).collect()] == ["west"]


def test_pages_over_the_cap_are_listed(spark):
    pages = spark.createDataFrame([(1, "u1", "x" * 1024), (2, "u2", "é" * 513), (3, "u3", None)], "page_id long, url string, html string")
    assert [tuple(r) for r in PG.rejected_pages(pages, max_bytes=1024).collect()] == [(2, "u2", 1026)]
    assert sorted(r["page_id"] for r in PG.cap_body_size(pages, max_bytes=1024).collect()) == [1, 3]


@pytest.mark.parametrize("query, kept", [
    ("b=%zz%41&x%20y%2=1", "b=%25zzA&x+y%252=1"), ("a=%", "a=%25"), ("a=%FF", "a=%EF%BF%BD"), ("q=1%2B1&UTM_x=2&gclid", "q=1%2B1"),
])
def test_malformed_escapes(spark, query, kept):
    assert spark.range(1).select(strip_tracking(F.lit(query))).first()[0] == kept


SHARED = "SharedAccessKeyName=sender;EntityPath=jobs;Endpoint=sb://Depot-7.example.net:443/;SharedAccessKey=a\\b\"c="


def test_servers():
    assert MSG.connection_host("Endpoint=sb://depot.example.net/") == "depot.example.net:9093"
    for wrong in ("", "Endpoint=https://depot.example.net/", "SharedAccessKey=x", "Endpoint=sb:///"):
        with pytest.raises(MSG.BrokerConfigError):
            MSG.connection_host(wrong)
    assert MSG.server_list("one:1,,two:2 ,") == ["one:1", "two:2"] and MSG.server_list(None) == []


def test_broker_settings():
    hub = MSG.broker_options(eventhub_connection_string=SHARED, bootstrap_servers=" relay:1 ", sasl_username="ignored")
    assert hub["kafka.bootstrap.servers"] == "relay:1" and hub["kafka.sasl.mechanism"] == "PLAIN"
    assert 'password="' + SHARED.replace("\\", "\\\\").replace('"', '\\"') + '"' in hub["kafka.sasl.jaas.config"]
    signed = MSG.broker_options(bootstrap_servers="x:1,y:2", security_protocol="SASL_PLAINTEXT", sasl_mechanism="SCRAM-SHA-256",
                                sasl_username="ann", sasl_password="pw", client_id="")
    assert signed["kafka.client.id"] == "jobloom" and 'username="ann" password="pw"' in signed["kafka.sasl.jaas.config"]
    assert set(MSG.broker_options(bootstrap_servers="x:1")) == {"kafka.bootstrap.servers", "kafka.client.id"}
    for nothing in ({}, {"bootstrap_servers": " , "}):
        with pytest.raises(MSG.BrokerConfigError):
            MSG.broker_options(**nothing)


def test_reading_settings():
    options = MSG.consumer_options(" posts ", bootstrap_servers="x:1", max_offsets_per_trigger=250)
    assert options["subscribe"] == "posts" and options["maxOffsetsPerTrigger"] == "250" and options["startingOffsets"] == "earliest"
    for wrong in ({"topic": " "}, {"topic": "posts", "starting_offsets": "42"}):
        with pytest.raises(MSG.BrokerConfigError):
            MSG.consumer_options(**wrong, bootstrap_servers="x:1")


@pytest.mark.parametrize("hub, codec, sent", [(False, None, "gzip"), (True, None, "none"), (True, "ZSTD ", "zstd"), (False, "Off", "none"),
                                              (False, " ", "gzip"), (False, "uncompressed", "none")])
def test_compression(hub, codec, sent):
    assert K.publish_options({}, event_hubs=hub, compression=codec)["kafka.compression.type"] == sent


@pytest.mark.parametrize("hub, asked, sent", [(False, None, True), (True, None, False), (True, "Yes", True), (False, "0", False), (True, "?", False)])
def test_headers(hub, asked, sent):
    assert K.include_headers(hub, asked) is sent


def test_hub_limits_and_overrides():
    options = K.publish_options({"kafka.client.id": "me"}, event_hubs=True, overrides={"kafka.linger.ms": "9"})
    assert options["kafka.client.id"] == "me" and options["kafka.linger.ms"] == "9" and options["kafka.max.request.size"] == "1000000"
    assert "kafka.max.request.size" not in K.publish_options({}, event_hubs=False)


def test_nothing_is_sent_if_one_payload_is_too_large(spark, tmp_path):
    sizes = spark.createDataFrame([("t", bytes([i]), b"v" * n) for i, n in enumerate((10, 1024, 1025))], "topic string, key binary, value binary")
    with pytest.raises(PayloadTooLarge, match="1025"):
        K.publish(sizes, sink_path=str(tmp_path / "none"), max_message_bytes=1024)
    assert not (tmp_path / "none").exists()
    K.publish(sizes, sink_path=str(tmp_path / "all"))
    assert spark.read.parquet(str(tmp_path / "all")).count() == 3


def test_one_message_for_a_run(spark):
    rows = spark.createDataFrame([(i, f"Post {i}") for i in range(1, 6)], "Index long, `Position title` string")
    message = single_message(rows, "t").collect()
    assert [(bytes(m["key"]), m["n_rows"]) for m in message] == [(b"open_positions", 5)]
    with pytest.raises(PayloadTooLarge):
        single_message(rows.withColumn("Position title", F.repeat("Position title", F.lit(5000))), "t", 1024)
