"""Fixed values for country names and ISO codes."""

# Country name aliases. None marks a name that stands for no country.
ALIASES = {
    "Türkiye": "Turkey",
    "United States": "United States of America",
    "Korea": "South Korea",
    "Korea, Republic of": "South Korea",
    "The Netherlands": "Netherlands",
    "United Kindgom": "United Kingdom",
    "Macedonia": "North Macedonia",
    "Northern Ireland": "United Kingdom",
    "Not specified": None,
    "USA": "United States of America",
    "UK": "United Kingdom",
    "England": "United Kingdom",
    "Scotland": "United Kingdom",
    "Iran (Islamic Republic of)": "Iran",
    "Iran, Islamic Republic of": "Iran",
    "Russian Federation": "Russia",
    "Russia Federation": "Russia",
    "Viet Nam": "Vietnam",
    "Lao People's Democratic Republic": "Laos",
    "Eqypt": "Egypt",
    "Columbia": "Colombia",
    "Czechia": "Czech Republic",
    "Democratic Republic of the Congo": "Democratic Republic of Congo",
    "Congo, Democratic Republic": "Democratic Republic of Congo",
    "Cote d'Ivoire": "Cote D`Ivoire (Ivory Coast)",
    "Côte D'Ivoire": "Cote D`Ivoire (Ivory Coast)",
    "Moldova, Republic of": "Moldova",
    "Unknown": None,
    "unknown": None,
    "N/A": None,
    "United States of America (USA)": "United States of America",
}

# Three-letter codes that override the standard table.
ISO_OVERRIDES = {
    "African Union": None,
    "European Union": None,
    "Test_Country": None,
    "Cape Verde": "CPV",
    "Cote D`Ivoire (Ivory Coast)": "CIV",
    "Democratic Republic of Congo": "COD",
    "Eswatini (Swaziland)": "SWZ",
    "Kosovo": "XKX",
    "Macau": "MAC",
    "Occupied Palestinian Territory": "PSE",
    "Saint Kitts & Nevis": "KNA",
    "Timor-Leste (East Timor)": "TLS",
    "Turkey": "TUR",
    "US Virgin Islands": "VIR",
    "West Bank and Gaza": "PSE",
}
