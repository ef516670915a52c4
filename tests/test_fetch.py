import numpy as np

from groundplan.operators import reports
from groundplan.sources.fetch import Fetcher, text_of


def test_fetcher_waits_and_tries_again():
    now, slept, answers = [0.0], [], {"http://a/1": [503, 429, 200], "http://a/2": [OSError, OSError, OSError], "http://a/3": [404], "http://a/4": [200]}

    def pause(s):
        slept.append(round(s, 3))
        now[0] += s

    def get(url):
        if url.endswith("robots.txt"):
            return 200, {}, b"User-agent: *\nDisallow: /no"
        x = answers[url].pop(0)
        if x is OSError:
            raise OSError
        return x, {}, b"ok"

    f = Fetcher(get, pause=pause, clock=lambda: now[0])
    assert f.fetch("http://a/no/1") == (None, None, 0)
    assert f.fetch("http://a/1") == ("ok", 200, 3) and slept == [10.0, 20.0]
    assert f.fetch("http://a/2") == (None, None, 3) and slept[2:] == [1.0, 2.0, 4.0]
    assert f.fetch("http://a/3") == (None, 404, 1) and f.fetch("http://a/4") == ("ok", 200, 1) and slept[5:] == [1.0, 1.0]


def test_broken_bodies_are_failures():
    import gzip

    bodies = {"http://a/1": ({}, gzip.compress(b"page " * 99)[:20]), "http://a/2": ({"Content-Type": "text/html; charset=undefined"}, b"caf\xe9"), "http://a/3": ({"Content-Type": "x; charset=idna"}, b"x")}
    get = lambda url: (404, {}, b"") if url.endswith("robots.txt") else (200, *bodies[url])
    f = Fetcher(get, delay=0.0, pause=lambda s: None)
    assert f.fetch("http://a/1") == (None, None, 3) and f.fetch("http://a/2") == ("caf\ufffd", 200, 1) and f.fetch("http://a/3") == ("x", 200, 1)


def test_text_of_a_body():
    import gzip

    assert text_of({}, gzip.compress("é".encode())) == "é" and text_of({"content-type": "x; charset=latin-1"}, b"\xe9") == "é" and text_of({"Content-Type": "x; charset=odd"}, b"a") == "a"


def test_shapiro_wilk_against_known_values():
    w, p = reports.normality(np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236.0]))
    assert abs(w - 0.79) < 0.005 and abs(p - 0.0067) < 0.001  # the example of the test's authors
    r = np.random.default_rng(1)
    assert reports.normality(r.normal(size=2000))[1] > 0.01 and reports.normality(r.exponential(size=2000))[1] < 1e-9
    assert reports.normality(np.ones(5)) is None and reports.normality(np.array([1.0, 2.0])) is None and reports.normality(np.array([1.0, 2.0, 3.0]))[0] > 0.99
