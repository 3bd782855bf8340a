"""Word lists of synthetic values.  A list is part of the key: its order and length never change."""

# These lists decide which synthetic value a digest stands for.

FIRST_NAMES = [
    "Abel", "Agnes", "Amos", "Anouk", "Benedikt", "Brigid", "Caspar", "Chiara", "Clement", "Dagny", "Desmond", "Edda", "Eskil", "Faye", "Florin", "Greta", "Hamid", "Ilse",
    "Ivo", "Jolana", "Kasimir", "Keiko", "Leonie", "Magnus", "Marguerite", "Nils", "Odile", "Otto", "Petra", "Ravi", "Renske", "Salome", "Silas", "Tibor", "Thora", "Uma", "Valentin", "Wanda", "Yara", "Zdeněk",
]

LAST_NAMES = [
    "Achterberg", "Bellini", "Brandvold", "Castellan", "Dvorak", "Engstrom", "Farquhar", "Gallagher", "Haverkamp", "Iversen", "Jaworski", "Kowalczyk", "Lefebvre", "Mendonca", "Norrington",
    "Okafor", "Pettersson", "Quigley", "Rosenthal", "Sagara", "Tanaka", "Underwood", "Van Houten", "Winterbourne", "Yamada", "Zimmer", "Zielińska", "Šimunić",
]

STREET_NAMES = [
    "Acorn", "Bracken", "Chestnut", "Drummond", "Eastgate", "Foxhollow", "Garland", "Hawthorn", "Inglewood", "Jasmine", "Kingfisher", "Linden", "Millrace", "Nightingale", "Overlook",
    "Poplar", "Quince", "Ridgeline", "Saltmarsh", "Tanglewood", "Upland", "Vineyard", "Willowbrook", "Yewtree",
]

STREET_TYPES = ["Boulevard", "Close", "Crescent", "Drive", "Place", "Road", "Row"]

CITIES = [
    "Appleford", "Brookmere", "Coldwater Bend", "Deepwell", "Elmsworth", "Fernley Cross", "Granby", "Hartsfield", "Ivydale", "Juniper Flats", "Kelmscott", "Lowmoor", "Millbank",
    "Newbridge", "Oxbow", "Pennyfield", "Redcliff", "Summerlea", "Whitewater",
]

EMAIL_DOMAINS = ["example.com", "example.edu", "example.net", "example.org"]

AREA_CODES = ["205", "217", "304", "316", "406", "501", "605", "701"]

COMPANY_HEADS = [
    "Amberfield", "Bluestem", "Cedarline", "Driftwood", "Eastlake", "Fairweather", "Goldleaf", "Highpoint", "Islander", "Jadestone", "Keystone", "Larkfield", "Mossbank",
    "Nettlecombe", "Oakline", "Peregrine", "Quartzite", "Riverbend", "Sunhollow", "Tidewater",
]

COMPANY_TAILS = ["Agency", "Alliance", "Brothers", "Company", "Enterprises", "Foundry", "Logistics", "Services", "Studios", "Traders"]

#: Three-digit postal areas with too few people to be told apart from.
RESTRICTED_ZIP3 = "036 059 063 102 203 556 692 790 821 823 830 831 878 879 884 890 893".split()
