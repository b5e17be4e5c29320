import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from channelwise.session import local_session  # noqa: E402
from channelwise.sources.schemas import RAW_MESSAGE  # noqa: E402

AS_OF = dt.datetime(2024, 1, 29, 12, 0, 0)


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="channelwise-tests")
    yield s
    s.stop()


def msg(message_id, channel="novapharma", date=dt.datetime(2024, 1, 20, 10, 0), text="Paracetamol 500mg tablet",
        views=100, forwards=5, has_media=False, image=False, username=None, title=None, scraped=None):
    """One raw message row (tuple in RAW_MESSAGE order)."""
    return (message_id, channel, username if username is not None else f"@{channel}",
            title if title is not None else f"Title {channel}", date, text, has_media,
            f"data/raw/images/{channel}/{message_id}.jpg" if image else None, views, forwards,
            scraped or (date + dt.timedelta(days=1) if date else dt.datetime(2024, 1, 28)))


@pytest.fixture
def raw_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, RAW_MESSAGE)
    return make
