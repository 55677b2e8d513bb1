import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from webtab.schemas import PAGES  # noqa: E402
from webtab.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4",
                            spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                            spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def page(spark):
    """``page(html, url)`` -> a one-row page table; a name ending in .html is a fixture file."""
    def make(html, url="https://en.wikipedia.org/wiki/Page", page_id=1):
        if html.endswith(".html") and "<" not in html:
            with open(os.path.join(ROOT, "tests", "fixtures", html), encoding="utf-8") as f:
                html = f.read()
        return spark.createDataFrame([(page_id, url, html)], PAGES)
    return make
