"""ZIP archives of land registry CSV files, one partition for each member, adapted to the raw contract."""

from __future__ import annotations

import csv
import io
import re
import sys
import zipfile
from collections.abc import Iterator
from itertools import batched

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from acreage.contract import RAW_COLUMNS
from acreage.functions.dates import split_compact
from acreage.functions.text import keyword_category, normalize_text

MEMBER = re.compile(r"^([a-z])_lvr_land_a\.csv$", re.IGNORECASE)
#: Fixed values of the published format: county by the letter of the file, renamed towns, columns.
COUNTIES = {
    "A": "臺北市", "B": "臺中市", "C": "基隆市", "D": "臺南市", "E": "高雄市", "F": "新北市", "G": "宜蘭縣", "H": "桃園市", "I": "嘉義市", "J": "新竹縣", "K": "苗栗縣",
    "M": "南投縣", "N": "彰化縣", "O": "新竹市", "P": "雲林縣", "Q": "嘉義縣", "T": "屏東縣", "U": "花蓮縣", "V": "臺東縣", "W": "金門縣", "X": "澎湖縣", "Z": "連江縣",
}
WHOLE_COUNTY_TOWNS = {"I": "東區", "O": "東區"}
TOWN_SPELLINGS = {("P", "台西鄉"): "臺西鄉", ("V", "台東市"): "臺東市"}
PARKING_HEADERS = ("車位移轉總面積平方公尺", "車位移轉總面積(平方公尺)")
HEADERS = {
    "town": "鄉鎮市區", "type": "交易標的", "trans_landsize": "土地移轉總面積平方公尺", "usage_type": "都市土地使用分區", "nonurban_type": "非都市土地使用分區", "date": "交易年月日", "building_type": "建物型態",
    "usage": "主要用途", "date_complete": "建築完成年月", "trans_size": "建物移轉總面積平方公尺", "room": "建物現況格局-房", "hall": "建物現況格局-廳", "bath": "建物現況格局-衛", "manage": "有無管理組織",
    "housing_totprice": "總價元", "h_price_m2": "單價元平方公尺", "parking_size": PARKING_HEADERS[0], "parking_price": "車位總價元", "note": "備註", "no": "編號",
}
URBAN = ("住", "商", "工", "農")
#: Rows that a reader hands over at once.
BATCH = 10_000


def members(path: str) -> list[tuple[str, str]]:
    """(county letter, member) of the transaction files, by letter; raises on anything that isn't as published."""
    try:
        with zipfile.ZipFile(path) as z:
            found = sorted((m[1].upper(), n) for n in z.namelist() if (m := MEMBER.match(n.rpartition("/")[2])))
    except zipfile.BadZipFile as error:
        raise ValueError(f"not a ZIP archive: {path}") from error
    letters = [c for c, _ in found]
    if not found:
        raise ValueError(f"no transaction file in {path}")
    if unknown := sorted(set(letters) - set(COUNTIES)):
        raise ValueError(f"unknown counties: {unknown}")
    if len(set(letters)) < len(letters):
        raise ValueError("a county has two files")
    return found


#: What each needed column can be called; all else in a file is left out.
SPELLINGS = {k: (PARKING_HEADERS if k == "parking_size" else (h,)) for k, h in HEADERS.items()}


def columns_of(header: list[str], member: str) -> dict[str, int]:
    """Where each needed column is: exactly one of its spellings must occur, exactly once. All faults are told at once."""
    places: dict[str, list[int]] = {}
    for k, name in enumerate(header):
        places.setdefault(name.removeprefix("\ufeff").strip(), []).append(k)
    found = {column: [k for spelling in spellings for k in places.get(spelling, [])] for column, spellings in SPELLINGS.items()}
    faults = [f"lacks {SPELLINGS[c][0]}" for c, at in found.items() if not at] + [
        f"has {SPELLINGS[c][0]} {len(at)} times" for c, at in found.items() if len(at) > 1
    ]
    faults += [
        f"repeats {name}" for name, at in places.items() if len(at) > 1 and not any(name in x for x in SPELLINGS.values())
    ]
    if faults:
        raise ValueError(f"{member} {', '.join(sorted(faults))}")
    return {c: at[0] for c, at in found.items()}


def rows_of(path: str, member: str) -> Iterator[list[str]]:
    """Header, then data rows; the line of English descriptions is skipped, and a row of another length is an error."""
    with zipfile.ZipFile(path) as z, z.open(member) as raw:
        reader = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", newline=""), strict=True)
        header = next(reader)
        yield header
        next(reader, None)
        for row in reader:
            if len(row) != len(header):
                raise ValueError(f"{member} line {reader.line_num}: {len(row)} fields")
            yield row


class Member(InputPartition):
    def __init__(self, order: int, letter: str, name: str):
        self.order, self.letter, self.name = order, letter, name


class LandZip(DataSource):
    """spark.read.format("land_zip").load(path): (letter, member_order, line, and a string for each needed column)."""

    @classmethod
    def name(cls) -> str:
        return "land_zip"

    def schema(self) -> str:
        for _, name in members(self.options["path"]):
            columns_of(next(rows_of(self.options["path"], name)), name)
        return "letter string, member_order int, line long, " + ", ".join(f"`{k}` string" for k in HEADERS)

    def reader(self, schema: StructType) -> DataSourceReader:
        return LandZipReader(self.options["path"])


class LandZipReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [Member(k, c, n) for k, (c, n) in enumerate(members(self.path))]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        rows = rows_of(self.path, partition.name)
        at = columns_of(next(rows), partition.name)
        names = ["letter", "member_order", "line", *at]
        for first, held in ((k * BATCH, chunk) for k, chunk in enumerate(batched(rows, BATCH))):
            n = len(held)
            columns = [
                pa.array([partition.letter] * n), pa.array([partition.order] * n, pa.int32()),
                pa.array(range(first, first + n), pa.int64())
            ]
            yield pa.RecordBatch.from_arrays(
                [*columns, *[pa.array([row[i] for row in held], pa.string()) for i in at.values()]], names
            )


def adapt(rows: DataFrame) -> DataFrame:
    """Archive rows as raw records (contract.RAW_COLUMNS) with _row_pos, the 1-based input order over all files."""
    c = F.col
    year, month, day = split_compact(normalize_text("date"))
    town: Column = normalize_text("town")
    for (letter, spelt), right in TOWN_SPELLINGS.items():
        town = F.when((c("letter") == letter) & (normalize_text("town") == spelt), right).otherwise(town)
    for letter, name in WHOLE_COUNTY_TOWNS.items():
        town = F.when(c("letter") == letter, name).otherwise(town)
    county = F.create_map(*[F.lit(x) for pair in COUNTIES.items() for x in pair])[c("letter")]
    own = {
        "trans_y": year, "trans_m": month, "trans_d": day, "county": county, "countycd": c("letter"), "town": town,
        "usage_type": keyword_category(normalize_text("usage_type"), URBAN, "其他")
    }
    # One row for each county's file, so neither the window nor the broadcast grows with the rows.
    earlier = Window.orderBy("member_order").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("member_order").agg(F.count("*").alias("n"))
    starts = sizes.select("member_order", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    placed = rows.join(F.broadcast(starts), "member_order")
    return placed.select(*[own.get(k, c(k)).alias(k) for k in RAW_COLUMNS], (c("start") + c("line") + 1).alias("_row_pos"))


def read_land_zip(spark: SparkSession, path: str) -> DataFrame:
    # The reader travels with its code, so workers needn't have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LandZip)
    return adapt(spark.read.format("land_zip").load(path))
