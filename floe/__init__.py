"""Spark operators for mapping land-fast sea ice from satellite radar archives.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing is collected to the driver.
"""

__version__ = "0.1.0"
