"""Registered queries over the test tables and the SQL each must agree with."""

from checks import acquisitions, focal, geometry, projections, statistics, timeseries

MODULES = (projections, statistics, acquisitions, focal, geometry, timeseries)
