"""Names and thresholds the results depend on."""

# ---- Fixed values: names and numbers that must stay exactly as they are. ----

TUGS = [
    "BELEN", "BOCAS DEL TORO", "CACIQUE I", "CALOVEBORA", "CECIL HAYNES", "CERRO ANCON", "CERRO AZUL",
    "CERRO CAMPANA", "CERRO CANAJAGUA", "CERRO GRANDE", "CERRO ITAMUT", "CERRO JEFE", "CERRO LA VIEJA",
    "CERRO MAJAGUAL", "CERRO MAJAGULA", "CERRO PANDO", "CERRO PICACHO", "CERRO PUNTA", "CERRO SANTIAGO",
    "CERRO TIGRE", "CHANGUINOLA I", "CHIRIQUI III", "COCLE", "COLON", "DARIEN", "DOLEGA", "MCAULIFFE",
    "ESTI", "FARFAN", "GILBERTO GUARDIA", "GUIA", "HERRERA", "LIDER", "LOS SANTOS", "PACORA",
    "PANAMA XIV", "PARITA I", "PEQUENI", "RIO_BAYANO", "RIO INDIO", "RIO TUIRA", "SAJALICES", "TERIBE",
    "TONOSI", "UNIDAD", "VERAGUAS I", "GORGONA I", "GUARDIA", "CHANGUINOLA", "SIXAOLA", "CULEBRA",
]
PORTS = [
    "Colon2000", "Atlantic - PPC Cristobal", "Pacific - PPC Balboa", "Pacific - PATSA",
    "Pacific - PSA", "MIT", "CCT", "LNG terminal", "Telfer", "Oil Tanking",
]
LOCKS = [
    "Gatun Locks Original", "Gatun Locks Expanded",
    "Pedro Miguel Locks Original", "Miraflores Locks Original",
    "Cocoli Locks",
]
ANCHORAGES = ["Atlantic Anchorage", "Pacific Anchorage"]
STOPS = [
    "Miraflores Waiting Area", "Pedro Miguel Mooring Station", "Gamboa Mooring station", "Gatun Anchorage",
]
ATLANTIC_ANCHORAGE = "Atlantic Anchorage"
GATUN_ANCHORAGE = "Gatun Anchorage"
ATLANTIC_ANCHORAGE_PARTS = [
    "Panama Canal - Atlantic - West Breakwater Inner Anchorage",
    "Panama Canal - Atlantic - East Breakwater Inner Anchorage",
    "Atlantic - West Breakwater Light Outer Anchorage",
]
ACCESS_ZONES = ["Atlantic Access", "Pacific Access"]
ORIGINAL_LOCK_PAIR = ["Miraflores Locks Original", "Gatun Locks Original"]
NEO_LOCK_PAIR = ["Gatun Locks Expanded", "Cocoli Locks"]
NORTHBOUND_FIRST_LOCKS = ["Miraflores Locks Original", "Cocoli Locks"]

BERTH = "Berth"
ANCHORAGE = "Anchorage"
MANOEUVRING = "Manoeuvring"
SLOW_TRANSIT = "Slow transit"
NORMAL_CRUISING = "Normal cruising"
TANKER_TYPES = ["Oil tanker", "Chemical tanker", "Liquified gas tanker", "Other liquids tankers"]

HOUR = 3600
DAY = 86400
SEGMENT_GAP = 72 * HOUR
UNDECIDED_GAP = 96 * HOUR
PORT_GAP = DAY
ANCHORAGE_GAP = HOUR
PORT_MIN_STAY = HOUR
LINK_GAP = HOUR
LOOK_BACK_DAYS = 15

# ---- Fixed values of the operational phase: knots and load. ----

BERTH_SPEED = 1
ANCHORAGE_SPEED = 3
MANOEUVRING_SPEED = 5
SLOW_LOAD = 0.65

# ---- Our own settings. ----

#: Width of a track slice: a task of a track window holds what one ship reports in a week.
SLICE_WIDTH = 7 * DAY

# ---- Fixed values of the position clustering. ----

DBSCAN_EPS_SOUTH = 0.0028
DBSCAN_EPS_OTHER = 0.0014
DBSCAN_MIN_POINTS = 3
