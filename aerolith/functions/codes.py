"""Country code table (ISO 3166) used by the country map feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Country name, ISO alpha-3 code, ISO numeric code.
COUNTRY_CODES = [
    ("United States", "USA", 840),
    ("China", "CHN", 156),
    ("Germany", "DEU", 276),
    ("United Kingdom", "GBR", 826),
    ("France", "FRA", 250),
    ("Russia", "RUS", 643),
    ("India", "IND", 356),
    ("Brazil", "BRA", 76),
    ("Canada", "CAN", 124),
    ("Australia", "AUS", 36),
    ("Japan", "JPN", 392),
    ("Netherlands", "NLD", 528),
    ("Spain", "ESP", 724),
    ("Italy", "ITA", 380),
    ("Turkey", "TUR", 792),
    ("Mexico", "MEX", 484),
    ("South Korea", "KOR", 410),
    ("Indonesia", "IDN", 360),
    ("Argentina", "ARG", 32),
    ("Poland", "POL", 616),
    ("Ukraine", "UKR", 804),
    ("Norway", "NOR", 578),
    ("Sweden", "SWE", 752),
    ("Switzerland", "CHE", 756),
    ("Belgium", "BEL", 56),
    ("Austria", "AUT", 40),
    ("Portugal", "PRT", 620),
    ("Greece", "GRC", 300),
    ("Denmark", "DNK", 208),
    ("Finland", "FIN", 246),
    ("Romania", "ROU", 642),
    ("Czech Republic", "CZE", 203),
    ("Hungary", "HUN", 348),
    ("Thailand", "THA", 764),
    ("Malaysia", "MYS", 458),
    ("Singapore", "SGP", 702),
    ("United Arab Emirates", "ARE", 784),
    ("Saudi Arabia", "SAU", 682),
    ("Qatar", "QAT", 634),
    ("South Africa", "ZAF", 710),
    ("Egypt", "EGY", 818),
    ("Morocco", "MAR", 504),
    ("Nigeria", "NGA", 566),
    ("Kenya", "KEN", 404),
    ("Ethiopia", "ETH", 231),
    ("New Zealand", "NZL", 554),
    ("Pakistan", "PAK", 586),
    ("Bangladesh", "BGD", 50),
    ("Philippines", "PHL", 608),
    ("Vietnam", "VNM", 704),
    ("Colombia", "COL", 170),
    ("Chile", "CHL", 152),
    ("Peru", "PER", 604),
    ("Venezuela", "VEN", 862),
    ("Israel", "ISR", 376),
    ("Iran", "IRN", 364),
    ("Iraq", "IRQ", 368),
    ("Kazakhstan", "KAZ", 398),
    ("Uzbekistan", "UZB", 860),
    ("Bulgaria", "BGR", 100),
    ("Serbia", "SRB", 688),
    ("Croatia", "HRV", 191),
    ("Slovakia", "SVK", 703),
    ("Slovenia", "SVN", 705),
    ("Lithuania", "LTU", 440),
    ("Latvia", "LVA", 428),
    ("Estonia", "EST", 233),
    ("Belarus", "BLR", 112),
    ("Moldova", "MDA", 498),
    ("Albania", "ALB", 8),
    ("North Macedonia", "MKD", 807),
    ("Bosnia and Herzegovina", "BIH", 70),
    ("Montenegro", "MNE", 499),
    ("Iceland", "ISL", 352),
    ("Luxembourg", "LUX", 442),
    ("Malta", "MLT", 470),
    ("Cyprus", "CYP", 196),
    ("Ireland", "IRL", 372),
    ("Panama", "PAN", 591),
    ("Costa Rica", "CRI", 188),
    ("Guatemala", "GTM", 320),
    ("Ecuador", "ECU", 218),
    ("Bolivia", "BOL", 68),
    ("Paraguay", "PRY", 600),
    ("Uruguay", "URY", 858),
    ("Cuba", "CUB", 192),
    ("Dominican Republic", "DOM", 214),
    ("Jamaica", "JAM", 388),
    ("Honduras", "HND", 340),
    ("El Salvador", "SLV", 222),
    ("Nicaragua", "NIC", 558),
    ("Trinidad and Tobago", "TTO", 780),
    ("Oman", "OMN", 512),
    ("Kuwait", "KWT", 414),
    ("Bahrain", "BHR", 48),
    ("Jordan", "JOR", 400),
    ("Lebanon", "LBN", 422),
    ("Yemen", "YEM", 887),
    ("Syria", "SYR", 760),
    ("Afghanistan", "AFG", 4),
    ("Myanmar", "MMR", 104),
    ("Cambodia", "KHM", 116),
    ("Laos", "LAO", 418),
    ("Sri Lanka", "LKA", 144),
    ("Nepal", "NPL", 524),
    ("Mongolia", "MNG", 496),
    ("Ghana", "GHA", 288),
    ("Ivory Coast", "CIV", 384),
    ("Senegal", "SEN", 686),
    ("Tanzania", "TZA", 834),
    ("Uganda", "UGA", 800),
    ("Mozambique", "MOZ", 508),
    ("Zimbabwe", "ZWE", 716),
    ("Zambia", "ZMB", 894),
    ("Angola", "AGO", 24),
    ("Cameroon", "CMR", 120),
    ("Congo", "COG", 178),
    ("Tunisia", "TUN", 788),
    ("Algeria", "DZA", 12),
    ("Libya", "LBY", 434),
    ("Sudan", "SDN", 729),
]


def country_codes(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Two lookups: country to alpha-3, alpha-3 to numeric.

    Both are literal tables of a fixed size, so they are broadcast.
    """
    names = F.array(*[F.struct(F.lit(n).alias("country"), F.lit(a).alias("iso_a3")) for n, a, _ in COUNTRY_CODES])
    numbers = F.array(*[F.struct(F.lit(a).alias("iso_a3"), F.lit(i).alias("number")) for _, a, i in COUNTRY_CODES])
    one = spark.range(1)
    return F.broadcast(one.select(F.inline(names))), F.broadcast(one.select(F.inline(numbers)))
