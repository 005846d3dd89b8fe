"""Sources and sinks: schemas, constant dimensions, readers, writers and the
role views that map the driver's test tables onto the planning data model."""
