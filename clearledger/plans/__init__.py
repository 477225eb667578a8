"""The layered warehouse: raw -> staging -> intermediate -> reporting, and its declared checks."""
