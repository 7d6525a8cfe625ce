"""Location text -> (country, province, city) (P11), as one ``CASE`` chain.

Rules, first match wins (positions 0-based in prose, Spark is 1-based):

* local-network text, null, empty, or text starting with ``CZ88`` after a
  trim -> China / Shanghai, no city;
* a province character at position > 0 -> province = text up to it, city =
  the text after it up to the next city character (inclusive) if any;
* text shorter than two characters -> all null;
* otherwise the first two characters select: Inner Mongolia (rest from
  position 3, city up to a city character), the four two-character
  autonomous regions (rest from position 2, same city rule), the four
  municipalities (province + city character, rest from position 3, city up
  to a district character), the two special administrative regions (no
  city); anything else is a foreign country kept as is.

The original's county fallback for municipalities can never fire (its guard
compares the default null city with a string), so it is not reproduced.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values used by the rules, in the order the rules consult them.
CHINA = "中国"
DEFAULT_PROVINCE = "上海市"
LOCAL_NETWORK = "局域网"
PLACEHOLDER_PREFIX = "CZ88"
PROVINCE_CHAR = "省"
CITY_CHAR = "市"
DISTRICT_CHAR = "区"
INNER_MONGOLIA_PREFIX = "内蒙"
INNER_MONGOLIA = "内蒙古自治区"
AUTONOMOUS_REGIONS = ["广西", "西藏", "宁夏", "新疆"]
MUNICIPALITIES = ["上海", "北京", "重庆", "天津"]
SPECIAL_REGIONS = ["香港", "澳门"]
SPECIAL_SUFFIX = "特别行政区"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _prefix_city(rest: Column, marker: str) -> Column:
    """Text of ``rest`` up to and including ``marker`` if it occurs after the
    first character, else null."""
    pos = F.instr(rest, marker)
    return F.when(pos > 1, F.substring(rest, F.lit(1), pos))


def normalize_region(c) -> Column:
    """Struct ``<country, province, city>`` of nullable strings."""
    text = _col(c)
    n = F.length(text)
    flag = F.substring(text, 1, 2)
    p_pos = F.instr(text, PROVINCE_CHAR)
    # the city character is searched from the province character onwards
    after_province = F.substring(text, p_pos, F.lit(1 << 30))
    c_rel = F.instr(after_province, CITY_CHAR)
    null = F.lit(None).cast("string")

    is_default = (text.isNull() | (n == 0) | (text == F.lit(LOCAL_NETWORK))
                  | F.trim(text).startswith(PLACEHOLDER_PREFIX))
    is_province = p_pos > 1
    too_short = n < 2
    is_mongolia = flag == F.lit(INNER_MONGOLIA_PREFIX)
    is_autonomous = flag.isin(AUTONOMOUS_REGIONS)
    is_municipal = flag.isin(MUNICIPALITIES)
    is_special = flag.isin(SPECIAL_REGIONS)
    domestic = is_default | is_province | is_mongolia | is_autonomous | is_municipal | is_special

    country = (F.when(domestic, F.lit(CHINA))
               .when(too_short, null)
               .otherwise(text))
    province = (F.when(is_default, F.lit(DEFAULT_PROVINCE))
                .when(is_province, F.substring(text, F.lit(1), p_pos))
                .when(too_short, null)
                .when(is_mongolia, F.lit(INNER_MONGOLIA))
                .when(is_autonomous, flag)
                .when(is_municipal, F.concat(flag, F.lit(CITY_CHAR)))
                .when(is_special, F.concat(flag, F.lit(SPECIAL_SUFFIX))))
    rest2 = F.substring(text, 3, 1 << 30)
    rest3 = F.substring(text, 4, 1 << 30)
    city = (F.when(is_default, null)
            .when(is_province,
                  F.when(c_rel > 0, F.substring(text, p_pos + 1, c_rel - 1)))
            .when(too_short, null)
            .when(is_mongolia & (n >= 3), _prefix_city(rest3, CITY_CHAR))
            .when(is_autonomous, _prefix_city(rest2, CITY_CHAR))
            .when(is_municipal & (n >= 3), _prefix_city(rest3, DISTRICT_CHAR)))
    return F.struct(country.alias("country"), province.alias("province"), city.alias("city"))
