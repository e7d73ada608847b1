"""Layer styles as text, and the order in which layers are drawn."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions import classes

#: Colours and opacity of the area layers.
FILLS = {
    "allotments": ((20, 45, 20), 0.5), "grass": ((20, 45, 20), 0.5), "meadow": ((20, 45, 20), 0.5), "leisure": ((20, 45, 20), 0.5), "leisure_relations": ((20, 45, 20), 0.5),
    "cemeteries": ((20, 45, 20), 0.5), "parks": ((15, 40, 15), 0.7), "forests": ((10, 35, 10), 0.7), "water": ((10, 18, 35), 1.0), "buildings": ((28, 28, 28), 1.0),
}
#: Colour and width of each road class, the empty one for all others.
ROAD_LINES = {
    "dojazdowa": ((50, 50, 50), 2), "ekspresowa": ((40, 40, 40), 1), "glownaRuchuPrzyspieszonego": ((40, 40, 40), 0.7), "glowna": ((40, 40, 40), 0.5), "zbiorcza": ((40, 40, 40), 0.3),
    "inna": ((50, 50, 50), 2), "lokalna": ((50, 50, 50), 2), "living_street": ((40, 40, 40), 0.2), "motorway": ((40, 40, 40), 1), "motorway_link": ((40, 40, 40), 0.4),
    "primary": ((40, 40, 40), 0.7), "primary_link": ((40, 40, 40), 0.4), "residential": ((40, 40, 40), 0.15), "secondary": ((40, 40, 40), 0.5), "secondary_link": ((40, 40, 40), 0.4),
    "tertiary": ((40, 40, 40), 0.4), "tertiary_link": ((40, 40, 40), 0.2), "trunk": ((40, 40, 40), 0.7), "trunk_link": ((40, 40, 40), 0.4), "unclassified": ((30, 60, 75), 0.15), "": ((20, 70, 60), 0.15),
}
RAILWAY = ((45, 40, 35), 0.7)

#: The light palettes of the frequency classes, index by index; "bmy" is the dark one backwards.
PALETTES = {
    "glasgow": (
        (219, 211, 255), (188, 198, 232), (163, 188, 213), (137, 178, 194), (111, 166, 171), (96, 153, 144), (97, 141, 115), (101, 130, 87), (106, 118, 58),
        (111, 105, 29), (114, 90, 6), (116, 74, 0), (116, 58, 1), (109, 40, 8), (94, 30, 21), (80, 26, 33), (67, 22, 44), (54, 18, 56),
    ),
    "batlow": (
        (250, 204, 250), (252, 192, 215), (253, 181, 183), (252, 170, 151), (245, 159, 116), (226, 150, 84), (201, 145, 60), (172, 140, 45), (143, 133, 45),
        (116, 126, 55), (91, 119, 68), (67, 111, 81), (46, 103, 92), (30, 92, 97), (21, 79, 97), (16, 65, 95), (12, 47, 93), (1, 25, 89),
    ),
    "hawaii": (
        (179, 241, 253), (137, 239, 239), (104, 233, 214), (95, 224, 182), (104, 214, 149), (118, 204, 116), (132, 192, 84), (145, 178, 54), (153, 159, 33),
        (156, 139, 27), (155, 120, 34), (154, 104, 44), (152, 88, 54), (150, 73, 64), (148, 59, 75), (146, 44, 86), (143, 27, 100), (140, 1, 115),
    ),
    "bmy": classes.COLORS[::-1],
    "fire": (
        (255, 255, 255), (255, 243, 36), (255, 220, 10), (255, 196, 4), (255, 171, 1), (255, 145, 0), (254, 115, 0), (253, 81, 0), (246, 38, 0),
        (223, 13, 0), (196, 7, 0), (169, 4, 0), (144, 3, 0), (118, 1, 0), (94, 1, 0), (71, 0, 0), (48, 0, 0), (0, 0, 0),
    ),
    "rainbow": (
        (0, 47, 245), (25, 91, 193), (34, 119, 144), (60, 139, 99), (66, 158, 49), (98, 173, 16), (144, 184, 20), (185, 194, 27), (224, 202, 34),
        (248, 196, 35), (249, 174, 31), (246, 150, 26), (243, 124, 22), (240, 97, 22), (243, 86, 57), (252, 103, 119), (255, 124, 183), (253, 145, 250),
    ),
    "sunset": (
        (243, 231, 155), (245, 218, 146), (247, 206, 138), (249, 193, 131), (249, 181, 129), (248, 168, 127), (246, 156, 126), (241, 144, 129), (237, 132, 132),
        (229, 122, 136), (219, 113, 140), (209, 104, 145), (195, 98, 150), (178, 94, 154), (162, 89, 159), (139, 87, 161), (115, 85, 163), (92, 83, 165),
    ),
}
#: The default light palette, and the opacity of the coverage layer.
PALETTE, COVERAGE_OPACITY = "glasgow", 0.9

#: Drawing order of the map's layers.
DRAW_ORDER = ("parks", "leisure_relations", "forests", "grass", "meadow", "allotments", "cemeteries", "water", "coverage", "buildings", "roads", "railways")


def ranges(spark: SparkSession, colors: tuple[tuple[int, int, int], ...] = classes.COLORS) -> DataFrame:
    """class, lower, upper, label, r, g, b, opacity of the frequency classes."""
    upper = (*classes.BREAKS[1:], classes.LAST_BREAK)
    rows = [(k, lo, hi, *rgb, COVERAGE_OPACITY) for k, (lo, hi, rgb) in enumerate(zip(classes.BREAKS, upper, colors, strict=True))]
    df = spark.createDataFrame(rows, "class int, lower int, upper int, r int, g int, b int, opacity double")
    return df.withColumn("label", classes.class_label(F.col("class")))


def coloured(regions: DataFrame, colors: tuple[tuple[int, int, int], ...] = classes.COLORS) -> DataFrame:
    """regions (with deduped_trips) that have a frequency, with class, r, g, b and opacity."""
    rows = regions.filter("deduped_trips > 0").withColumn("class", classes.frequency_class(F.col("deduped_trips")))
    return rows.join(F.broadcast(ranges(regions.sparkSession, colors).select("class", "r", "g", "b", "opacity")), "class")  # one row a class


def draw_order(layer):
    """Place of a layer in the drawing, null for layers that aren't drawn."""
    return F.nullif(F.array_position(F.array(*map(F.lit, DRAW_ORDER)), layer), F.lit(0))


def range_elements(spark: SparkSession) -> DataFrame:
    """class, element: the style file's range of each class."""
    text = F.format_string('<range lower="%d" upper="%d" symbol="%d" label="%s" render="true"/>', "lower", "upper", "class", "label")
    return ranges(spark).select("class", text.alias("element"))


def symbol(name: str, rgb: tuple[int, int, int], kind: str = "fill", alpha: float = 1.0, width: float | None = None) -> str:
    colour = ",".join(map(str, rgb)) + ",255"
    options = {"color": colour, "outline_color": "0,0,0,0", "outline_style": "no", "style": "solid"}
    if kind == "line":
        options = {"line_color": colour, "line_style": "solid", "line_width": str(width or 0.26)}
    inner = "".join(f'<Option name="{k}" type="QString" value="{v}"/>' for k, v in options.items())
    return f'<symbol name="{name}" type="{kind}" alpha="{alpha}"><layer class="Simple{kind.title()}"><Option type="Map">{inner}</Option></layer></symbol>'


def document(renderer: str, body: str, opacity: float = 1.0) -> str:
    return (
        "<!DOCTYPE qgis PUBLIC 'http://mrcc.com/qgis.dtd' 'SYSTEM'>\n"
        f'<qgis version="3.34" styleCategories="Symbology|Rendering"><renderer-v2 {renderer}>{body}</renderer-v2><layerOpacity>{opacity}</layerOpacity></qgis>\n'
    )


def graduated(attribute: str = "deduped_trips", opacity: float = COVERAGE_OPACITY, colors: tuple[tuple[int, int, int], ...] = classes.COLORS) -> str:
    """The style of the coverage layer."""
    upper = (*classes.BREAKS[1:], classes.LAST_BREAK)
    labels = [f"{a} - {b}" if b < classes.LAST_BREAK else f"{a}+" for a, b in zip(classes.BREAKS, upper, strict=True)]
    parts = "".join(f'<range lower="{a}" upper="{b}" symbol="{k}" label="{x}" render="true"/>' for k, (a, b, x) in enumerate(zip(classes.BREAKS, upper, labels, strict=True)))
    symbols = "".join(symbol(str(k), rgb) for k, rgb in enumerate(colors))
    return document(f'type="graduatedSymbol" attr="{attribute}" graduatedMethod="GraduatedColor"', f"<ranges>{parts}</ranges><symbols>{symbols}</symbols>", opacity)


def categorized(attribute: str = "highway", values: dict[str, tuple[tuple[int, int, int], float]] = ROAD_LINES) -> str:
    """A style with a symbol for each value; the empty value is the default."""
    parts = "".join(f'<category value="{v}" symbol="{k}" label="{v}" render="true"/>' for k, v in enumerate(values))
    symbols = "".join(symbol(str(k), rgb, "line", width=width) for k, (rgb, width) in enumerate(values.values()))
    return document(f'type="categorizedSymbol" attr="{attribute}"', f"<categories>{parts}</categories><symbols>{symbols}</symbols>")


def single(rgb: tuple[int, int, int], opacity: float = 1.0, kind: str = "fill") -> str:
    return document('type="singleSymbol"', f"<symbols>{symbol('0', rgb, kind)}</symbols>", opacity)


def documents() -> dict[str, str]:
    """Style text of every layer, by layer name."""
    fills = {name: single(rgb, opacity) for name, (rgb, opacity) in FILLS.items()}
    light = {f"light/transit_frequency_{name}": graduated(colors=colors) for name, colors in PALETTES.items()} | {"light/transit_frequency": graduated(colors=PALETTES[PALETTE])}
    return fills | light | {"railways": single(*RAILWAY, "line"), "roads": categorized(), "coverage_map": graduated()}
