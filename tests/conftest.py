import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="cohortlens-tests")
    yield s
    s.stop()


RAW_COLS = ("_row_id long, nk_ota_localizer_id string, fk_contact string, date_purchase string, time_purchase string, "
            "gmv_success double, total_tickets_quantity_success long, place_origin_departure string, "
            "place_destination_departure string, place_origin_return string, place_destination_return string, "
            "fk_departure_ota_bus_company string, fk_return_ota_bus_company string")


def raw_row(i, key, contact="c1", date="2024-01-10", time="10:00:00", gmv=100.0, tickets=1, oo="A", do="B",
            orr="0", dr="0", co="X", cr="1"):
    return (i, key, contact, date, time, gmv, tickets, oo, do, orr, dr, co, cr)
