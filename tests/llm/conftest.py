from __future__ import annotations

import pytest
from samples import corpus, frame

from panelworks.llm import store


@pytest.fixture(scope="session")
def llm(spark):
    return store.prepared(spark)


@pytest.fixture(scope="session")
def documents(llm):
    return frame(llm, corpus()).cache()


@pytest.fixture(scope="session")
def nothing(llm):
    return frame(llm, [], 1)
