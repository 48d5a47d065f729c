"""End-to-end plans and the derived views the registered queries run on."""
