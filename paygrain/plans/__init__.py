"""The payroll star schema, its checks, its reports and the run that ties them together."""
