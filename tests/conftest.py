import io
import json
import sys
import tarfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stoplines.plans.ingest import run_ingest  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A zone with clock changes: zone-less times must not notice it.
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.sql.session.timeZone", "Europe/Berlin")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def write_archive(path: Path, members: list[tuple[str, str | bytes]]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w:gz") as tar:
        for name, text in members:
            content = text.encode() if isinstance(text, str) else text
            info = tarfile.TarInfo(name)
            info.size = len(content)
            tar.addfile(info, io.BytesIO(content))


def timetable(station: str | None, *stops: str) -> str:
    root = f' station="{station}"' if station is not None else ""
    return f"<timetable{root}>{''.join(stops)}</timetable>"


def stop(stop_id: str, label: str = "", **events: str) -> str:
    """stop("1", "S 73768", ar="pt=2509021500 l=7")"""
    text = ""
    if label:
        kind, number = label.split()
        text += f'<tl c="{kind}" n="{number}" o="08"/>'
    for tag, attributes in events.items():
        pairs = " ".join('{}="{}"'.format(*a.split("=")) for a in attributes.split())
        text += f"<{tag} {pairs}/>"
    return f'<s id="{stop_id}">{text}</s>'


MAIN, ALEX, SPANDAU, SUED = (
    "Berlin Hauptbahnhof", "Berlin Alexanderplatz", "Berlin-Spandau", "Berlin Südkreuz",
)


def _station(name, point, *numbers):
    lat, lon = point
    return {
        "name": name,
        "evaNumbers": [
            {"number": n, "isMain": main, "geographicCoordinates": {"coordinates": [lon, lat]}}
            for n, main in numbers
        ],
    }


STATIONS = {
    "result": [
        _station(MAIN, (52.525, 13.369), (9001, False), (1001, True)),
        _station(ALEX, (52.521, 13.411), (1002, True)),
        _station(SPANDAU, (52.534, 13.197), (1003, True)),
        _station(SUED, (52.475, 13.365), (1004, True)),
        _station("Ohne Haupt", (52.4, 13.3), (1005, False)),
    ]
}

PLANNED = [
    ("250902_0700/a_timetable.xml", timetable(
        MAIN,
        stop("78-2509020730-1", "RB 7", dp="pt=2509020730"),
        stop("81-2509020700-1", "RB 7", dp="pt=2509020700"),
    )),
    ("250902_0900/b_timetable.xml", timetable(MAIN, stop("80-2509020900-1", "RB 7", dp="pt=2509020900"))),
    ("250902_1500/c_timetable.xml", timetable(
        MAIN, stop("-12-2509021500-1", "S 73768", dp="pt=2509021500"))),
    ("250902_1500/d_timetable.xml", timetable(
        ALEX, stop("-12-2509021500-2", "S 73768", ar="pt=2509021510", dp="pt=2509021511"))),
    ("250902_1500/e_timetable.xml", timetable(
        SPANDAU, stop("-12-2509021500-3", "S 73768", ar="pt=2509021530"))),
    ("250902_1700/f_timetable.xml", timetable(
        ALEX, stop("34-2509021705-1", "RE 12", dp="pt=2509021705"))),
    ("250902_1700/g_timetable.xml", timetable(
        SUED, stop("34-2509021705-2", "RE 12", ar="pt=2509021720"))),
    ("250902_1800/g_timetable.xml", timetable(
        SUED, stop("34-2509021705-2", "RE 12", ar="pt=2509021725"))),
    ("250902_2300/h_timetable.xml", timetable(
        ALEX, stop("56-2509022355-1", "S 73768", dp="pt=2509022355"))),
    ("250903_0800/i_timetable.xml", timetable(
        MAIN, stop("79-2509030859-1", "RB 7", dp="pt=2509030859"))),
    ("250903_0800/readme.txt", "not a document"),
]

CHANGED = [
    ("250902_1500/1.xml", timetable(ALEX, stop("-12-2509021500-2", ar="ct=2509021515"))),
    ("250902_1515/2.xml", timetable(
        ALEX, stop("-12-2509021500-2", ar="ct=2509021517", dp="ct=2509021520"))),
    ("250902_1516/3.xml", timetable(SPANDAU, stop("-12-2509021500-3", ar="cs=c"))),
    ("250902_1700/4.xml", timetable(ALEX, stop("34-2509021705-1", dp="ct=2509021700"))),
    ("250902_2300/5.xml", timetable(ALEX, stop("56-2509022355-1", dp="ct=2509030003"))),
    ("250902_2301/6.xml", timetable(ALEX, stop("99-2509021500-1", ar="ct=2509021540"))),
    ("250902_2302/7.xml", timetable(SPANDAU, stop("-12-2509021500-3", ar="cs=p ct=2509021531"))),
    ("250902_2303/8.xml", timetable(MAIN, stop("-12-2509021500-1", ar="ct=2509021455"))),
]


class Snapshot:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name):
        return self.spark.read.parquet(f"{self.folder}/{name}")


@pytest.fixture(scope="session")
def delivery(tmp_path_factory) -> Path:
    folder = tmp_path_factory.mktemp("delivery")
    (folder / "stations.json").write_text(json.dumps(STATIONS, ensure_ascii=False))
    write_archive(folder / "timetables" / "250902_250903.tar.gz", PLANNED)
    write_archive(folder / "changes" / "250902_250903.tar.gz", CHANGED)
    return folder


@pytest.fixture(scope="session")
def small(spark, delivery) -> Snapshot:
    out = delivery / "snapshot"
    run_ingest(
        spark, f"{delivery}/stations.json", f"{delivery}/timetables", f"{delivery}/changes", str(out)
    )
    return Snapshot(spark, str(out))
