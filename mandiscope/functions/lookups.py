"""Lookup tables, word lists and thresholds that decide results."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


# States per region of India.
STATE_REGION = [
    ("Delhi", "North India"), ("Haryana", "North India"), ("Himachal Pradesh", "North India"),
    ("Jammu and Kashmir", "North India"), ("Ladakh", "North India"), ("Punjab", "North India"),
    ("Rajasthan", "North India"), ("Uttar Pradesh", "North India"), ("Uttarakhand", "North India"),
    ("Goa", "West India"), ("Gujarat", "West India"), ("Maharashtra", "West India"),
    ("Andhra Pradesh", "South India"), ("Karnataka", "South India"), ("Kerala", "South India"),
    ("Tamil Nadu", "South India"), ("Telangana", "South India"), ("Bihar", "East India"),
    ("Jharkhand", "East India"), ("Odisha", "East India"), ("West Bengal", "East India"), ("Sikkim", "East India"),
    ("Arunachal Pradesh", "Northeast India"), ("Assam", "Northeast India"), ("Manipur", "Northeast India"),
    ("Meghalaya", "Northeast India"), ("Mizoram", "Northeast India"), ("Nagaland", "Northeast India"),
    ("Tripura", "Northeast India"), ("Chhattisgarh", "Central India"), ("Madhya Pradesh", "Central India"),
]

# Cities per state. The order decides which city a partial match takes first.
CITY_STATE = [
    ("Delhi", "Delhi"), ("New Delhi", "Delhi"), ("Chandigarh", "Punjab"), ("Jaipur", "Rajasthan"),
    ("Lucknow", "Uttar Pradesh"), ("Kanpur", "Uttar Pradesh"), ("Agra", "Uttar Pradesh"),
    ("Varanasi", "Uttar Pradesh"), ("Amritsar", "Punjab"), ("Dehradun", "Uttarakhand"),
    ("Shimla", "Himachal Pradesh"), ("Mumbai", "Maharashtra"), ("Pune", "Maharashtra"), ("Nagpur", "Maharashtra"),
    ("Ahmedabad", "Gujarat"), ("Surat", "Gujarat"), ("Vadodara", "Gujarat"), ("Rajkot", "Gujarat"), ("Goa", "Goa"),
    ("Panaji", "Goa"), ("Bangalore", "Karnataka"), ("Bengaluru", "Karnataka"), ("Mysore", "Karnataka"),
    ("Hubli", "Karnataka"), ("Chennai", "Tamil Nadu"), ("Coimbatore", "Tamil Nadu"), ("Madurai", "Tamil Nadu"),
    ("Hyderabad", "Telangana"), ("Warangal", "Telangana"), ("Kochi", "Kerala"), ("Thiruvananthapuram", "Kerala"),
    ("Kozhikode", "Kerala"), ("Visakhapatnam", "Andhra Pradesh"), ("Vijayawada", "Andhra Pradesh"),
    ("Tirupati", "Andhra Pradesh"), ("Kolkata", "West Bengal"), ("Howrah", "West Bengal"), ("Patna", "Bihar"),
    ("Ranchi", "Jharkhand"), ("Jamshedpur", "Jharkhand"), ("Bhubaneswar", "Odisha"), ("Cuttack", "Odisha"),
    ("Guwahati", "Assam"), ("Shillong", "Meghalaya"), ("Imphal", "Manipur"), ("Aizawl", "Mizoram"),
    ("Agartala", "Tripura"), ("Kohima", "Nagaland"), ("Bhopal", "Madhya Pradesh"), ("Indore", "Madhya Pradesh"),
    ("Jabalpur", "Madhya Pradesh"), ("Raipur", "Chhattisgarh"),
]

# Cities looked for inside free location text, in search order.
SCRAPE_CITIES = [
    "Mumbai", "Delhi", "Bangalore", "Chennai", "Hyderabad", "Pune", "Kolkata", "Ahmedabad", "Jaipur", "Surat",
    "Lucknow", "Indore", "Coimbatore", "Vadodara", "Nagpur", "Bhopal",
]

# Standard unit and its spellings.
UNIT_SPELLINGS = [
    ("kg", "kg"), ("kgs", "kg"), ("kilogram", "kg"), ("kilograms", "kg"), ("g", "grams"), ("gram", "grams"),
    ("grams", "grams"), ("mg", "milligrams"), ("milligram", "milligrams"), ("milligrams", "milligrams"),
    ("lb", "pounds"), ("lbs", "pounds"), ("pound", "pounds"), ("pounds", "pounds"), ("oz", "ounces"),
    ("ounce", "ounces"), ("ounces", "ounces"), ("meter", "meters"), ("meters", "meters"), ("m", "meters"),
    ("cm", "centimeters"), ("centimeter", "centimeters"), ("centimeters", "centimeters"), ("mm", "millimeters"),
    ("millimeter", "millimeters"), ("millimeters", "millimeters"), ("km", "kilometers"),
    ("kilometer", "kilometers"), ("kilometers", "kilometers"), ("inch", "inches"), ("inches", "inches"),
    ("in", "inches"), ("foot", "feet"), ("feet", "feet"), ("ft", "feet"), ("yard", "yards"), ("yards", "yards"),
    ("yd", "yards"), ("liter", "liters"), ("liters", "liters"), ("l", "liters"), ("ml", "milliliters"),
    ("milliliter", "milliliters"), ("milliliters", "milliliters"), ("gallon", "gallons"), ("gallons", "gallons"),
    ("gal", "gallons"), ("quart", "quarts"), ("quarts", "quarts"), ("qt", "quarts"), ("pint", "pints"),
    ("pints", "pints"), ("pt", "pints"), ("square meter", "square meters"), ("square meters", "square meters"),
    ("sqm", "square meters"), ("m2", "square meters"), ("square foot", "square feet"),
    ("square feet", "square feet"), ("sqft", "square feet"), ("ft2", "square feet"), ("acre", "acres"),
    ("acres", "acres"), ("piece", "pieces"), ("pieces", "pieces"), ("pc", "pieces"), ("pcs", "pieces"),
    ("unit", "units"), ("units", "units"), ("set", "sets"), ("sets", "sets"), ("pair", "pairs"),
    ("pairs", "pairs"), ("box", "boxes"), ("boxes", "boxes"), ("pallet", "pallets"), ("pallets", "pallets"),
    ("roll", "rolls"), ("rolls", "rolls"), ("sheet", "sheets"), ("sheets", "sheets"), ("ton", "tons"),
    ("tons", "tons"), ("tonne", "tons"), ("tonnes", "tons"),
]

# Currency symbols and names. The yen and yuan share one sign, which means yuan here.
CURRENCY_NAMES = [
    ("$", "USD"), ("US DOLLAR", "USD"), ("DOLLAR", "USD"), ("€", "EUR"), ("EURO", "EUR"), ("£", "GBP"),
    ("BRITISH POUND", "GBP"), ("POUND", "GBP"), ("₹", "INR"), ("INDIAN RUPEE", "INR"), ("RUPEE", "INR"),
    ("¥", "CNY"), ("CHINESE YUAN", "CNY"), ("YUAN", "CNY"), ("JAPANESE YEN", "JPY"), ("YEN", "JPY"),
]

# Static conversion rates, units of USD per unit of currency.
USD_RATES = [("USD", 1.0), ("INR", 0.012), ("CNY", 0.14), ("EUR", 1.08), ("GBP", 1.25), ("JPY", 0.0067)]

# Dashboard vocabularies.
CATEGORIES = ["Industrial Machinery", "Electronics", "Textiles", "Chemicals", "Agriculture"]
REGIONS = ["North India", "West India", "South India", "East India", "Central India", "Northeast India"]
TIERS = ["Gold", "Silver", "Unverified"]
PRICE_BAND_EDGES = [0, 100, 500, 1000, 5000, 10000]
PRICE_BAND_LABELS = ["$0-100", "$100-500", "$500-1K", "$1K-5K", "$5K-10K", "$10K+"]

# Entity rules. Materials are single words; the others are a number and a unit.
MATERIALS = [
    "steel", "aluminum", "plastic", "copper", "brass", "glass", "wood", "cotton", "polyester", "nylon",
]
MEASUREMENT_UNITS = [
    "mm", "cm", "m", "kg", "g", "mg", "l", "ml", "inch", "inches", "ft", "feet", "yards",
]
POWER_UNITS = [
    "w", "kw", "hp",
]
FREQUENCY_UNITS = [
    "hz", "khz", "mhz",
]

# Words that open a phrase without carrying meaning.
LEADING_WORDS = [
    "a", "an", "the", "this", "that", "these", "those",
]

# Default English function words; callers may pass another list.
STOP_WORDS = LEADING_WORDS + [
    "i", "me", "my", "we", "our", "us", "you", "your", "he", "him", "his", "she", "her", "it", "its", "they",
    "them", "their", "who", "whom", "whose", "which", "what", "and", "or", "but", "nor", "so", "yet", "if", "then",
    "else", "than", "because", "as", "until", "while", "when", "where", "why", "how", "all", "any", "both", "each",
    "few", "more", "most", "other", "some", "such", "no", "not", "only", "own", "same", "too", "very", "can",
    "will", "just", "should", "could", "would", "may", "might", "must", "shall", "is", "am", "are", "was", "were",
    "be", "been", "being", "have", "has", "had", "do", "does", "did", "doing", "of", "at", "by", "for", "with",
    "about", "against", "between", "into", "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "once", "here", "there", "also",
    "per", "via",
]


def lookup_frame(spark: SparkSession, pairs: list[tuple], key: str, value: str) -> DataFrame:
    """A fixed table as a local relation, whose exact size the planner knows."""
    keys, values = zip(*pairs)
    return spark.createDataFrame(
        pa.table({key: list(keys), value: list(values)})
    )
