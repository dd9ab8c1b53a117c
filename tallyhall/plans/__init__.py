"""End-to-end plans over the fixture tables and the driver query catalog."""
