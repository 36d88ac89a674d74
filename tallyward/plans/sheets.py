"""Small reports on sheets: the place list and the profit template."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.text import contains_any
from tallyward.operators.frames import first_row_as_pairs

# Words that take a place off the list, by name and by address.
NAME_WORDS = ("齿科", "宠物", "口腔")
ADDRESS_WORDS = ("太仓", "常熟", "张家港", "昆山", "吴江")

# Column order of the profit template.
PROFILE_COLUMNS = (
    "年",
    "月",
    "诊所名称",
    "诊疗费",
    "辅助检查",
    "西／成药处方",
    "中药处方",
    "治疗费",
    "实验室检查",
    "材料费",
    "其他收费",
    "收入合计",
    "诊疗费成本",
    "辅助检查成本",
    "西／成药处方成本",
    "中药处方成本",
    "治疗成本",
    "实验室检查成本",
    "材料费成本",
    "其他收费成本",
    "成本合计",
    "诊疗费利润",
    "辅助检查利润",
    "西／成药处方利润",
    "中药处方利润",
    "治疗费利润",
    "实验室检查利润",
    "材料费利润",
    "其他收费利润",
    "利润合计",
)


def exclude_by_words(places: DataFrame, words: Mapping[str, Collection[str]]) -> DataFrame:
    """Drop the rows in which any of the columns has one of its words; null cells never match."""
    rest = places
    for column, listed in words.items():
        rest = rest.filter(~contains_any(column, listed))
    return rest


def filter_places(places: DataFrame, name: str = "名称", address: str = "地址") -> DataFrame:
    """The place list without the places its usual words rule out."""
    return exclude_by_words(places, {name: NAME_WORDS, address: ADDRESS_WORDS})


def reorder_profile(profile: DataFrame, columns: Collection[str] = PROFILE_COLUMNS) -> DataFrame:
    """The template's columns in their order; any others are left out."""
    return profile.select(*[F.col(f"`{c}`") for c in columns])


def profile_head(profile: DataFrame, order: Collection[str], columns: Collection[str] = PROFILE_COLUMNS) -> DataFrame:
    """The first row of the reordered template as (field, value) pairs."""
    return first_row_as_pairs(reorder_profile(profile, columns), list(order))
