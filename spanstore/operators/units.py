"""Shape of extracted units."""

from ..functions.locators import LOCATOR

UNIT = f"struct<locator:{LOCATOR},text:string,meta:map<string,string>,verbatim:boolean>"
UNITS = f"array<{UNIT}>"
