import pytest

from fragstream.plans import processor

from . import streams

TEXT = """@prefix p: <http://pipe/#> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
<step> a p:Client ; p:url <http://host/stream> ; p:output <out> ; p:before "2025-01-01T00:00:00Z"^^xsd:dateTime ; p:after "2024-01-01T00:00:00Z"^^xsd:dateTime ;
  p:ordered "ascending" ; p:follow true ; p:interval 500 ; p:shapeFile "shape.ttl" ; p:noShape false ; p:savePath "state" ; p:loose true ; p:urlIsView true ;
  p:materialize true ; p:startFresh true ; p:lastVersionOnly true ; p:streamId "s" ; p:sdsify true ;
  p:fetch [ p:concurrent 5 ; p:safe true ; p:auth [ p:auth "user:pass" ; p:host "host" ] ; p:retry [ p:code 408, 503 ; p:maxRetry 3 ] ] .
"""


def test_every_option_is_read_from_rdf():
    options = processor.options_in(TEXT, "http://base/", "http://pipe/#")
    assert options["streamId"] == "s" and options["sdsify"] is True and options["output"] == "http://base/out"
    c = processor.config_of(options)
    assert (c.url, c.before, c.after, c.ordered, c.polling, c.poll_interval_ms) == ("http://host/stream", "2025-01-01T00:00:00Z", "2024-01-01T00:00:00Z", "ascending", True, 500)
    assert (c.shape_file, c.no_shape, c.state_path, c.loose, c.url_is_view, c.materialize, c.start_fresh, c.last_version_only) == ("shape.ttl", False, "state", True, True, True, True, True)
    assert (c.fetch.concurrent, c.fetch.safe, c.fetch.username, c.fetch.password, c.fetch.auth_host, c.fetch.codes, c.fetch.max_retries) == (5, True, "user", "pass", "host", (408, 503), 3)
    one = processor.options_in('<step> <http://pipe/#url> <http://h/s> ; <http://pipe/#fetch> [ <http://pipe/#retry> [ <http://pipe/#code> 404 ; <http://pipe/#maxRetry> 9 ] ] .', "http://base/", "http://pipe/#")
    c = processor.config_of(one)
    assert (c.fetch.codes, c.fetch.max_retries) == ((404,), 9)
    assert processor.config_of({"url": "http://h:81/s", "fetch": {"auth": {"auth": "u:p"}, "retry": {"codes": [500], "maxRetries": 2}}}).fetch.auth_host == "h:81"
    with pytest.raises(ValueError, match="unknown options of fetching: tries"):
        processor.config_of({"url": "http://h/s", "fetch": {"retry": {"tries": 1}}})
    with pytest.raises(ValueError, match="unknown options: speed"):
        processor.config_of({"url": "x", "speed": 1})
    with pytest.raises(ValueError, match="url is needed"):
        processor.config_of({})
    with pytest.raises(ValueError, match="one resource"):
        processor.options_in("", "http://base/", "http://pipe/#")


def test_members_go_to_a_channel(spark, site, tmp_path):
    url = streams.plain(site)
    texts = []
    step = processor.Processor(spark, {"url": url, "ordered": "descending", "sdsify": True, "streamId": "http://s", "fetchConfig": {"concurrent": 2}})
    assert step.produce(texts.append) == 12 and len(texts) == 12
    assert all("<http://s>" in t and "sds#payload" in t for t in texts) and "e6 1" in texts[0]
    state = {"url": url, "savePath": f"file://{tmp_path}/s", "fetchConfig": {"concurrent": 2}}
    assert processor.Processor(spark, state).produce(lambda t: False) == 0
    assert processor.Processor(spark, state).produce(texts.append) == 12
    assert processor.Processor(spark, state).produce(texts.append) == 0
