"""Which inputs are written before they are read."""

from testkit.derive import STORED


def test_texts_that_are_scanned_once_are_not_stored_as_well():
    assert not {"events_raw", "responses", "cdrs_raw"} & set(STORED)
