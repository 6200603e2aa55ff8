import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from oxbow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

# A made-up sample of the option-profit job's two files: CRLF line ends, and one
# header row whose names differ from the declared schema.
BASE_CSV = "\r\n".join([
    "Vehicle ID,Quantity,Code,Description,Model,Price",
    "1,1,ROOF,Roof,K10 long wheelbase,500",
    "2,3,ROOF,Roof,K10 short,900",
    "3,2,ROOF,Roof,M7 city,400",
    "4,1,WHEEL,Wheel,K20 sport,80",
    "5,1,ROOF,Roof,K10 basic,0",
    "6,-1,ROOF,Roof,M7 city,-75",
    "7,1,,,K10 basic,10",
    "8,1,PAINT,Paint,,120",
    "9,2,PAINT,Paint,K20 basic,333",
    "10,1,BELT,Belt,K10 basic,200", ""])
OPTIONS_CSV = "\r\n".join([
    "Model name,Code,Description,Cost",
    "K10,ROOF,steel,150", "K10,ROOF,glass,250", "K20,ROOF,steel,350",
    "K20,PAINT,matt,90", "K20,PAINT,gloss,91", "M9,PAINT,matt,92",
    "M9,SEAT,plain,10", "M9,SEAT,heated,10", "Z1,SEAT,,35",
    "M9,BELT,red,100", "Z1,BELT,red,100", "Z1,BELT,blue,101", ""])


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    s = build_session("local[4]", app="oxbow-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="oxbow-test-", dir="/tmp")


def write_text(folder: str, name: str, text: str) -> str:
    p = os.path.join(folder, name)
    with open(p, "w", newline="") as f:
        f.write(text)
    return p


@pytest.fixture()
def sample_csvs(workdir):
    return (write_text(workdir, "Base_dataset.csv", BASE_CSV),
            write_text(workdir, "Options_dataset.csv", OPTIONS_CSV))


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as printed by ``explain``."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
